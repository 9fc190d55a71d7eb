import time

import pytest
from pyspark.sql import functions as F

from answerloom.functions.normalization import (
    bare_form,
    expression_form,
    fractions_inline,
    is_number,
    roots_inline,
    simple_form,
    split_commas,
    text_form,
    to_double,
)


def check(one_column, function, table):
    assert one_column(function, [t for t, _ in table]) == [want for _, want in table]


def test_simple_form(one_column):
    check(one_column, simple_form, [
        (r" $\left( 3, \frac{\pi}{2} \right)$ ", r"3,\frac{\pi}{2}"),
        (r"\frac{1}{2}", r"\frac{1}{2"),
        (r"\boxed{7}", "7"),
        (r"\boxed{}", ""),
        ("(", "("),
        ("()", ""),
        (r"a\,b\ c", "abc"),
    ])


def test_bare_form(one_column):
    check(one_column, bare_form, [
        ("42", "42"),
        (r"$ \text{Evelyn} $", "Evelyn"),
        (r"\text{\mathrm{\mathbf{x}}}", "x"),
        (r"\text{\text{\text{\text{a}}}}", r"\text{a}"),
        (r"\leftarrow x", "arrowx"),
        (r"\le\leftft x", r"\leftx"),
        (r"1\,000\ km", "1000km"),
        ("a b\x1fc", "abc"),
        ("a\\ ", "a\\"),
        (r"\text{open", r"\text{open"),
        ("", ""),
        (None, None),
    ])


def test_text_form(one_column):
    check(one_column, text_form, [
        (r"{ \text{Blue} }", "blue"), ("{A}{B}", "a}{b"), ("{", "{"), ("Été", "été"),
    ])


def test_numbers(one_column):
    texts = ["1", "+1.", "-.5", "1.2.3", "1e5", "1,000", ".", "", "$ 4 $", "٣", "1_0", "1d", "0x1"]
    assert one_column(is_number, texts) == [
        True, True, True, False, False, False, False, False, True, True, False, False, False,
    ]
    assert one_column(to_double, texts) == [
        1.0, 1.0, -0.5, None, 1e5, None, None, None, 4.0, 3.0, 10.0, None, None,
    ]


def test_split_commas(one_column):
    check(one_column, split_commas, [
        ("1, 2 ,3", ["1", "2", "3"]),
        ("(1,2),3", ["(1,2)", "3"]),
        ("[1,2),3", ["[1,2)", "3"]),
        ("1),(2,3", ["1)", "(2,3"]),
        (")(a,b),c", [")(a,b)", "c"]),
        ("{a,(b,[c,d])},e", ["{a,(b,[c,d])}", "e"]),
        ("(a,b", ["(a,b"]),
        (",,a,", ["a"]),
        ("", []),
        (None, None),
    ])


def test_split_commas_against_a_character_walk(one_column):
    import random

    def walk(text):
        parts, depth, part = [], 0, ""
        for ch in text:
            depth = depth + 1 if ch in "([{" else max(0, depth - 1) if ch in ")]}" else depth
            if ch == "," and not depth:
                parts, part = [*parts, part], ""
            else:
                part += ch
        return [p.strip() for p in [*parts, part] if p.strip()]

    rng = random.Random(5)
    texts = ["".join(rng.choice("ab,, ([{)]}") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    assert one_column(split_commas, texts) == [walk(text) for text in texts]


def test_expression_form(one_column):
    check(one_column, expression_form, [
        (r"90^\circ", "90*pi/180"),
        (r"2 \cdot \pi^{2} \times x\!", "2*pi**(2)*x"),
        (r"\frac{1}{2}", r"\frac(1)(2)"),
    ])


def test_fractions_inline(one_column):
    check(one_column, fractions_inline, [
        (r"\frac{1}{2}+\dfrac{a{b}}{c}", "((1))/((2))+((a{b}))/((c))"),
        (r"\frac{\frac{1}{2}}{3}", r"((\frac{1}{2}))/((3))"),
        (r"\frac{1 \frac{2}{3}", r"\frac{1 ((2))/((3))"),
        (r"\frac12", r"\frac12"),
        (r"\frac{1}2", r"\frac{1}2"),
        ("$1", "$1"),
    ])


def test_roots_inline(one_column):
    check(one_column, roots_inline, [
        (r"\sqrt{2}+\sqrt{a{b}}", "sqrt((2))+sqrt((a{b}))"),
        (r"\sqrt{a\sqrt{b\sqrt{c}}}", "sqrt((asqrt((bsqrt((c))))))"),
        (r"\sqrt{1} \sqrt{2 \sqrt{3}", r"sqrt((1)) \sqrt{2 \sqrt{3}"),
        (r"\sqrt[3]{2}", r"\sqrt[3]{2}"),
        ("x", "x"),
        (None, None),
    ])


@pytest.mark.parametrize("function", [bare_form, simple_form, fractions_inline])
def test_dollar_and_backslash_are_literal(one_column, function):
    assert one_column(function, [r"\frac{$1}{\2}"])[0] is not None


def test_ordinary_texts_are_rewritten_by_patterns_and_others_alike(spark):
    """Few braces take patterns, many take pieces; both leave what is not closed.  Pieces took some 0.4 ms a row."""
    few, deep = "\\frac{{1}}{\\sqrt{2}}+\\sqrt{x+\\sqrt{3}}+\\sqrt{open \\sqrt{4} \\frac{5}", "{" * 200 + "y" + "}" * 200
    df = spark.range(100_000).select(F.concat_ws("+", F.lit(few), "id").alias("t")).repartition(4)
    made = df.select(fractions_inline(F.col("t")).alias("f"), roots_inline(F.col("t")).alias("r"))
    got = made.first()
    assert got.f.startswith("(({1}))/((\\sqrt{2}))+\\sqrt{x+\\sqrt{3}}+\\sqrt{open \\sqrt{4} \\frac{5}+")
    assert got.r.startswith("\\frac{{1}}{sqrt((2))}+sqrt((x+sqrt((3))))+\\sqrt{open \\sqrt{4} \\frac{5}+")
    start = time.monotonic()
    made.write.format("noop").mode("overwrite").save()
    assert time.monotonic() - start < 8
    many = spark.createDataFrame([(f"\\frac{{{deep}}}{{2}}\\sqrt{{{deep}}}",)], "t STRING")
    got = many.select(fractions_inline(F.col("t")).alias("f"), roots_inline(F.col("t")).alias("r")).first()
    assert got.f == f"(({deep}))/((2))\\sqrt{{{deep}}}" and got.r == f"\\frac{{{deep}}}{{2}}sqrt(({deep}))"
    inside = spark.createDataFrame([("\\sqrt{" * n + "z" + "}" * n,) for n in (7, 8, 9, 30)], "t STRING")
    assert [r.x for r in inside.select(roots_inline(F.col("t")).alias("x")).collect()] == ["sqrt((" * n + "z" + "))" * n for n in (7, 8, 9, 30)]
