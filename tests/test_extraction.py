from answerloom.functions.columns import last_line, strip
from answerloom.functions.extraction import (
    answer_line,
    hash_line,
    last_box,
    robust_answer,
    simple_answer,
    simple_box,
)


def check(one_column, function, table):
    assert one_column(function, [t for t, _ in table]) == [want for _, want in table]


def test_simple_box(one_column):
    check(one_column, simple_box, [
        (r"\boxed{1} then \boxed{ 2 }", "2"),
        (r"\boxed{\frac{14}{3}}", r"\frac{14"),
        (r"\boxed{}", ""),
        (r"\boxed{1} \boxed{open", "1"),
        (r"\fbox{1}", None),
        ("nothing", None),
        (None, None),
    ])


def test_last_box(one_column):
    check(one_column, last_box, [
        (r"\boxed{\frac{14}{3}}", r"\frac{14}{3}"),
        (r"\boxed{a{b{c{d{e{f}}}}}g}h}", "a{b{c{d{e{f}}}}}g"),
        (r"\boxed{1} and \fbox{ 2 }", "2"),
        (r"\fbox{1} and \boxed{2}", "2"),
        (r"\boxed{1} and \boxed{2", None),
        (r"\boxed{1} and \boxed{\frac{2}{3}", None),
        (r"\boxed{a \fbox{b} c}", "b"),
        (r"\boxed{x}} }{", "x"),
        (r"\boxed{ }", ""),
        (r"\boxed{" + "{" * 200 + "}" * 200 + "}", "{" * 200 + "}" * 200),
        (r"\boxed{é}ü", "é"),
        ("", None),
        (None, None),
    ])


def test_last_box_in_a_long_open_tail(one_column):
    text = r"\boxed{" + r"\frac{1}{2} " * 5000
    assert one_column(last_box, [text, text + "}"]) == [None, (r"\frac{1}{2} " * 5000).strip()]


def test_marker_lines(one_column):
    check(one_column, answer_line, [
        ("my answer: 3 but answer: 4", "3 but answer: 4"),
        ("FINAL Answer - 7\nnext", "7"),
        ("Answer:\n\n42", "42"),
        ("Answer: x=5\r\nbye", "x=5"),
        ("answer:   \n  ", ""),
        ("the answer is 3", None),
        ("anſwer: 1", "1"),
    ])
    check(one_column, hash_line, [
        ("work\n#### 5 \nmore", "5"),
        ("##### 5", "# 5"),
        ("### 5", None),
        ("####\n\n 6", "6"),
    ])


def test_last_line(one_column):
    check(one_column, last_line, [
        ("a\n b \n\n \t\n", "b"),
        ("one", "one"),
        ("a\rb", "b"),
        ("a\x0bb\x0cc", "c"),
        ("a b ", "b"),
        ("a\x85b\x1cc\x1dd\x1ee", "e"),
        ("a\x1fb", "a\x1fb"),
        (" \n　", ""),
        ("", ""),
    ])


def test_strip_knows_unicode_spaces(one_column):
    check(one_column, strip, [
        ("　\x1f x y \xa0\r\n", "x y"),
        ("​z", "​z"),
    ])


def test_robust_answer(one_column):
    check(one_column, robust_answer, [
        (r"So \boxed{\frac{1}{2}}. answer: 9", r"\frac{1}{2}"),
        (r"\boxed{ }" + "\nAnswer: 3", "3"),
        (r"\boxed{1} \boxed{2" + "\n#### 4", "4"),
        (r"So \boxed{1} and \boxed{2", r"So \boxed{1} and \boxed{2"),
        ("x\nAnswer:   \n#### 4", "#### 4"),
        ("Answer: ", ""),
        ("a\n\nb\n", "b"),
        ("", ""),
        (" \n ", ""),
        (None, ""),
    ])


def test_simple_answer_keeps_an_empty_box(one_column):
    check(one_column, simple_answer, [
        (r"\boxed{}" + "\nAnswer: 3", ""),
        ("Answer: 3\n#### 4", "3"),
        ("#### 4\nlast", "4"),
        ("one\ntwo", "two"),
        (None, ""),
    ])
