"""Answers nested to any depth, against plain recursion, and the time they take."""

import random
import sys
import time

import pytest
from pyspark.sql import functions as F

from answerloom.functions.equivalence import answers_match, bare_match
from answerloom.functions.normalization import bare_form, fractions_inline, roots_inline, split_commas
from tests import recursive as deep


def tower(depth, core, left="(0,", right=")"):
    return left * depth + core + right * depth


def test_tuples_and_sets_of_any_depth(spark):
    rows = []
    for depth in (*range(1, 13), 150):
        for left, right in (("(0,", ")"), ("{0,", "}"), ("({2,", "},1)"), ("{(1,", "),7}")):
            for other, same in (("1.0", True), ("2", False)):
                rows.append((tower(depth, "1", left, right), tower(depth, other, left, right), same))
    rows.append(("{(1,(2,(3,(4,5)))),{6,{7,8}}}", "{{{8,7},6},(1.0,(2,(3,(4,5.0))))}", True))
    df = spark.createDataFrame(rows, "p string, g string, same boolean").repartition(4)
    wrong = df.withColumn("got", answers_match(F.col("p"), F.col("g"))).filter("got <> same or got is null").collect()
    assert wrong == []


def odd_answers(n, seed, deepest=3, open_ended=True):
    pick = random.Random(seed)
    leaves = ["1", "1.0", "-2.", ".5", "x", "Blue", "blue", "\\text{Blue}", "\\frac{1}{2}", "x+1", "", " ", "$3$", "1_0", "(", ")", "{", "²", "٣"]
    if not open_ended:  # brackets that match: others are looked into only so far
        leaves = [x for x in leaves if x not in "(){"] + ["(1)(2)", "f(x)", "[1,2]"]

    def one(depth):
        if not depth or pick.random() < 0.3:
            return pick.choice(leaves)
        inner = ",".join(one(depth - 1) for _ in range(pick.randrange(4)))
        left, right = pick.choice(["()", "{}", "[]", ("\\left(", "\\right)"), ("(", "")] if open_ended else ["()", "{}", "()", "{}", "[]"])
        return left + inner + right

    return [one(deepest) for _ in range(n)]


def test_deep_answers_agree_with_recursion(spark):
    """Wide and deep, with sets in another order, other spellings of a number, and single changes."""
    pick = random.Random(11)
    leaves = ["1", "2", "-3.5", "x", "Blue", "\\frac{1}{2}", "x+1", "0.1", "(5)", "5"]

    def tree(depth):
        if depth == 0:
            return pick.choice(leaves)
        kind = pick.choice(["()", "{}"])
        inner = [tree(depth - 1) if k == 0 or pick.random() < 0.3 else pick.choice(leaves) for k in range(pick.randrange(1, 4))]
        pick.shuffle(inner)
        return (kind, inner)

    def text(node, vary):
        if isinstance(node, str):
            if vary and pick.random() < 0.5:
                return {"1": "1.0", "2": "+2", "-3.5": "-3.50", "Blue": "blue", "x": "x ", "5": "(5)"}.get(node, node)
            return node if not vary or pick.random() < 0.99 else "9"
        kind, inner = node
        if vary and kind == "{}":
            inner = pick.sample(inner, len(inner))
        return kind[0] + (" , " if vary else ",").join(text(i, vary) for i in inner) + kind[1]

    pairs = []
    for k in range(1500):
        node = tree(pick.randrange(4, 9))
        pairs.append((text(node, False), text(node, True)))
    texts = odd_answers(300, 12, deepest=7, open_ended=False)
    pairs += [(t, pick.choice(texts)) for t in texts] + [(t, t.replace("1.0", "1").replace("Blue", "blue")) for t in texts]
    df = spark.createDataFrame(pairs, "p string, g string").repartition(4).select(
        "p", "g", bare_form(F.col("p")).alias("bp"), bare_form(F.col("g")).alias("bg"),
        answers_match(F.col("p"), F.col("g")).alias("got"),
    ).collect()
    blank = lambda t: not t.strip()
    wrong = [r for r in df if r.got != (not blank(r.p) and not blank(r.g) and deep.agree(r.bp, r.bg))]
    assert wrong == []
    assert 300 < sum(r.got for r in df) < len(df) - 300


def test_very_deep_answers_agree_with_recursion(spark):
    sys.setrecursionlimit(100_000)
    rows = [(tower(d, "1", left, right), tower(d, "1.0", left, right)) for d in (4, 5, 60) for left, right in (("(0,", ")"), ("{0,", "}"), ("(", ")"), ("{", "}"), ("((1,2),", ",{3})"))]
    rows += [(p.replace("0", "7", 1), g) for p, g in rows] + [(p, g[:-1] + ")") for p, g in rows]
    df = spark.createDataFrame(rows, "p string, g string").repartition(2).select("p", "g", answers_match(F.col("p"), F.col("g")).alias("got"))
    for r in df.collect():
        assert r.got == deep.agree(r.p, r.g), r


def test_both_routes_agree(spark):
    texts = odd_answers(400, 1)
    pick = random.Random(2)
    pairs = [(t, t if k % 4 == 0 else pick.choice(texts)) for k, t in enumerate(texts)]
    pairs += [(t, t.replace("1.0", "1").replace("Blue", "blue")) for t in texts]
    df = spark.createDataFrame(pairs, "p string, g string").select(
        "p", "g", bare_form(F.col("p")).alias("bp"), bare_form(F.col("g")).alias("bg")
    )
    for r in df.select("*", bare_match(F.col("bp"), F.col("bg")).alias("same")).collect():
        assert (deep.bare(r.p), deep.bare(r.g)) == (r.bp, r.bg)
        assert deep.agree(r.bp, r.bg) == r.same, r


def test_parts_agree(one_column):
    texts = odd_answers(300, 3) + ["(1)," + "1," * 700, "a)b,c(d,e)f,g", "),),(,)", "[(,)],{,},", ",,(,),,"]
    assert one_column(split_commas, texts) == [deep.parts(t) for t in texts]


def braces(n, seed):
    pick = random.Random(seed)
    pieces = ["\\frac", "\\dfrac", "\\sqrt", "{", "{", "}", "}", "a", "1", "+", "\\frac{1}{2}", "\\sqrt{3}"]
    return ["".join(pick.choice(pieces) for _ in range(pick.randrange(1, 14))) for _ in range(n)]


def test_fractions_and_roots_agree(one_column):
    texts = braces(500, 4)
    assert one_column(fractions_inline, texts) == [deep.fractions(t) for t in texts]
    assert one_column(roots_inline, texts) == [deep.roots(t) for t in texts]


@pytest.mark.parametrize("depth", [1, 6, 7, 8, 12, 39, 40, 41, 50, 400])
def test_deep_fractions_and_roots(one_column, depth):
    core = "{" * depth + "x" + "}" * depth
    assert one_column(fractions_inline, [f"\\frac{{{core}}}{{2}}+\\dfrac{{1}}{{{core}}}"]) == [f"(({core}))/((2))+((1))/(({core}))"]
    nested = "\\sqrt{" * depth + "x" + "}" * depth
    want = "sqrt((" * depth + "x" + "))" * depth
    texts = [nested, f"\\sqrt{{2}}+\\sqrt{{{core}}}+\\sqrt{{3}}", f"{nested}\\sqrt{{open\\sqrt{{2}}"]
    assert one_column(roots_inline, texts) == [want, f"sqrt((2))+sqrt(({core}))+sqrt((3))", f"{want}\\sqrt{{open\\sqrt{{2}}"]


def timed(spark, function, text):
    """The best of three runs; the expression is written out and resolved beforehand."""
    df = spark.createDataFrame([(text,)], "t string").cache()
    df.count()
    result = df.select(function(F.col("t")).alias("x"))
    best = 1e9
    for _ in range(3):
        start = time.monotonic()
        result.write.format("noop").mode("overwrite").save()
        best = min(best, time.monotonic() - start)
    return best


def test_work_grows_with_the_text(spark):
    parts = lambda n: "(1)," + "1," * n
    roots = lambda n: "\\sqrt{" * n + "}" * n + "\\frac{1}{2}" * n
    match = lambda t: answers_match(t, F.concat(t, F.lit(" ")))
    only_roots = lambda n: "\\sqrt{" * n + "x" + "}" * n
    for function, text, most in (
        (split_commas, parts, 2), (roots_inline, only_roots, 2), (fractions_inline, roots, 5), (roots_inline, roots, 5)
    ):
        few, many = timed(spark, function, text(10_000)), timed(spark, function, text(40_000))
        # Four times the text, sorting and garbage collection included; quadratic work would take sixteen times as long.
        assert many < most and many < 10 * few + 0.5, (function.__name__, few, many)
    flat = lambda n: "((1)," + "1," * n + "1)"
    few, many = timed(spark, match, flat(1_500)), timed(spark, match, flat(6_000))
    assert many < 10 and many < 6 * few + 0.5, (few, many)


@pytest.mark.parametrize("left, right", [("(0,", ")"), ("(", ",1)"), ("{0,", "}"), ("([", "])")])
def test_deep_answers_take_time_near_linear(spark, left, right):
    """The two differ innermost, so every level has to be looked at."""
    match = lambda t: answers_match(t, F.replace(t, F.lit("77"), F.lit("77.0")))
    few, many = (timed(spark, match, tower(n, "77", left, right)) for n in (2_000, 8_000))
    assert many < 4 and many < 8 * few + 0.5, (few, many)
