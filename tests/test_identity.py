"""Equality of expressions as rational functions."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from answerloom.functions.identity import MOST, plain_expression, same_expression
from answerloom.functions.normalization import bare_form
from answerloom.functions.rational import expression_values, same_values
from answerloom.operators.grading import with_match

SAME = [
    ("\\frac{1}{2}", "0.5"), ("\\dfrac{3}{6}", "1/2"), ("(x+1)^2", "x^2+2x+1"),
    ("(x+y)(x-y)", "x^2-y^2"), ("2\\pi", "\\pi\\cdot 2"), ("-x^2", "-(x^2)"), ("2^3^2", "512"), ("-2^2", "-4"),
    ("\\frac{x^2-1}{x-1}", "x+1"), ("x^{-1}", "1/x"), ("$\\frac{\\frac{1}{2}}{3}$", "1/6"), ("1/2x", "x/2"),
    ("90^\\circ", "\\pi/2"), ("1.50", "3/2"), (".5", "1/2"), ("x y", "xy"), ("+x", "x"), ("--1", "1"), ("2 \\times 3", "6"),
    ("(a+b)^{3}", "a^3+3*a^2*b+3*a*b^2+b^3"), ("0.1+0.2", "0.3"), ("10000000000000000000001", "10^{22}+1"),
    ("((((x))))", "x"), ("2(x+1)", "2x+2"), ("(1)(2)", "2"), ("5 \\div 2", "2.5"),
]
DIFFERENT = [("x+1", "x+2"), ("\\frac{1}{3}", "0.3333333333"), ("x^2", "2x"), ("-2^2", "4"), ("2^31", "2^32"), ("x", "y"), ("0", "1"), ("2147483647", "0"), ("X", "x")]
UNDECIDED = [
    ("\\sqrt{2}", "\\sqrt{2}+0"), ("1/0", "1/0"), ("x=2", "2"), ("(1,2)", "(1,2)"), ("", "0"), ("x+", "x"), ("(x", "x"), ("x)", "x"), ("*x", "x"),
    ("x^y", "x^y"), ("x^{0.5}", "x"), ("2^{1001}", "2^{1001}+0"), (None, "1"), ("1..2", "1"), ("()", "0"), ("1/(x-x)", "1/(x-x)"),
]


def verdicts(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p string, g string")
    return [r.same for r in df.select("i", same_expression(F.col("p"), F.col("g")).alias("same")).orderBy("i").collect()]


@pytest.mark.parametrize("pairs, want", [(SAME, True), (DIFFERENT, False), (UNDECIDED, None)])
def test_verdicts(spark, pairs, want):
    got = verdicts(spark, pairs)
    assert [p for p, v in zip(pairs, got) if v is not want] == []


def test_random_expressions_against_exact_arithmetic(spark):
    """Trees of numbers and two symbols; the truth comes from exact values at many points."""
    pick = random.Random(4)

    def tree(depth):
        if depth == 0 or pick.random() < 0.2:
            return pick.choice(["x", "y", str(pick.randrange(5)), "0.5"])
        op = pick.choice("+-*/^")
        return ("^", tree(depth - 1), str(pick.randrange(4))) if op == "^" else (op, tree(depth - 1), tree(depth - 1))

    def text(t):
        if isinstance(t, str):
            return t
        op, a, b = t
        return f"\\frac{{{text(a)}}}{{{text(b)}}}" if op == "/" and pick.random() < 0.5 else f"({text(a)}){op}({text(b)})"

    def value(t, at):
        if isinstance(t, str):
            return at.get(t) if t in at else Fraction(t)
        op, a, b = t
        a, b = value(a, at), value(b, at)
        return a + b if op == "+" else a - b if op == "-" else a * b if op == "*" else a / b if op == "/" else a ** int(b)

    points = [{"x": Fraction(pick.randrange(10**6), 7), "y": Fraction(pick.randrange(10**6), 11)} for _ in range(4)]
    trees = [tree(3) for _ in range(60)]
    pairs, truth = [], []
    for a in trees:
        for b in (pick.choice(trees), ("+", a, "0"), ("*", a, pick.choice(["1", "2"]))):
            try:
                truth.append(all(value(a, p) == value(b, p) for p in points))
                pairs.append((text(a), text(b)))
            except ZeroDivisionError:
                del truth[len(pairs):]
    got = verdicts(spark, pairs)
    assert [(p, t, v) for p, t, v in zip(pairs, truth, got) if t != v] == []
    assert sum(truth) > 60 and MOST >= 1000


def test_long_expressions(spark):
    long = "+".join(f"{k}x" for k in range(400))
    assert verdicts(spark, [(long, f"{sum(range(400))}x"), ("(" * 300 + "x" + ")" * 300, "x"), ("x" * 20_000, "x")]) == [True, True, None]


def by_values(spark, pairs):
    """The verdicts of values made over Arrow batches."""
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, p string, g string")
    plain = df.select("i", *(plain_expression(bare_form(F.col(c))).alias(c) for c in "pg")).cache()
    values = plain.select("i", expression_values(F.array("p", "g")).alias("v"))
    return [r.same for r in values.select("i", same_values(F.get("v", F.lit(0)), F.get("v", F.lit(1))).alias("same")).orderBy("i").collect()]


def odd_pairs(n, seed):
    pick = random.Random(seed)
    tokens = ["x", "y", "ab", "2", "12", "0.5", ".5", "3.", "0", "1", "+", "-", "*", "/", "^", "(", ")", "(", ")", "\\frac{1}{2}", "2147483647", "\\pi"]
    texts = ["".join(pick.choice(tokens) for _ in range(pick.randrange(1, 7))) for _ in range(n)]
    return [(t, pick.choice([f"({t})", f"{t}+0", pick.choice(texts)])) for t in texts]


def test_values_decide_as_the_column_does(spark):
    long = "9" * 9_000
    pairs = [*SAME, *DIFFERENT, *UNDECIDED, (long, long + "+0"), ("1/2147483647", "2/4294967294"), *odd_pairs(300, 5)]
    want = verdicts(spark, pairs)
    got = by_values(spark, pairs)
    assert [(p, w, v) for p, w, v in zip(pairs, want, got) if w is not v] == []
    assert {True, False, None} <= set(want[len(SAME) + len(DIFFERENT) + len(UNDECIDED) :])


GROUPS = [
    ("(1/2,3)", "(0.5,6/2)", 1), ("(1/2,3)", "(3,0.5)", 0), ("{1/2,3}", "{6/2,0.5}", 1), ("{x+1,x+1}", "{1+x,x+2}", 0),
    ("({1/2,2},x)", "({4/2,0.5}, x)", 1), ("(1,{2,(3,4/2)})", "(1,{(3,2.0),2})", 1), ("((((1/2))))", "((((0.5))))", 1),
    ("(1,(2,(3,(4,{5,1/2}))))", "(1,(2,(3,(4,{0.5,5}))))", 1), ("(1,(2,(3,(4,{5,1/2}))))", "(1,(2,(3,(4,{0.5,6}))))", 0),
    ("((x+1),2)", "(x+1,2)", 1), ("(a,b)", "(A,B)", 1), ("()", "(1)", 0), ("(1,2", "(1,2)", 0), ("{(1,2),(3,4)}", "{(3,8/2),(1,2)}", 1),
    ("\\left( \\frac{x}{2}, 1 \\right)", "(0.5x,1)", 1), (" ", "1", 0), (None, "1", 0), ("x=1", "x=1+0", 0),
]


def test_grades_of_groups(spark):
    df = spark.createDataFrame([(i, *g) for i, g in enumerate(GROUPS)], "i int, p string, g string, want int")
    rows = with_match(df, "p", "g", "got", identities=True).collect()
    assert [(r.p, r.g, r.got) for r in rows if r.got != r.want] == []
    assert len(rows) == len(GROUPS) and set(rows[0].asDict()) == {"i", "p", "g", "want", "got"}


def test_grades_make_values_over_arrow_batches(spark, capsys):
    """The stack of the column form is folded over for each row and took about a millisecond."""
    with_match(spark.createDataFrame([("x", "x+0")], "p string, g string"), "p", "g", "ok", identities=True).explain()
    assert "ArrowEvalPython" in capsys.readouterr().out
