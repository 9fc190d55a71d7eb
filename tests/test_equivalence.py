import pytest
from pyspark.sql import functions as F

from answerloom.functions.equivalence import answers_match, simple_match
from answerloom.operators.grading import (
    correct_counts_once_per_pair,
    grade_runs,
    grade_runs_once_per_pair,
    grade_runs_simple,
    with_match,
)
from tests.golden_rows import ROWS

# (prediction, gold, agrees)
TABLE = [
    # blank and missing
    (None, "1", False), ("1", None, False), ("", "", False), (" \t", "1", False),
    # equal once bare
    ("$ 4 $", "4", True), (r"\left(3,\frac{\pi}{2}\right)", r"\left( 3, \frac{\pi}{2} \right)", True),
    ("$$", r"\,", True),
    # gold made of words decides alone
    ("evelyn", r"\text{Evelyn}", True), ("{Blue}", "blue", True), ("pi", r"\pi", False),
    ("x", "y", False), ("(a)", "a", False),
    # tuples, in order
    ("(1.0, 2)", "(1,2.00)", True), ("(2,1)", "(1,2)", False), ("(1,2,3)", "(1,2)", False),
    ("((1.0,2),3)", "((1,2),3.0)", True), ("(((1.0,2),3),4)", "(((1,2),3.0),4)", True),
    ("(1)(2.0)", "(1)(2)", False), ("()", "( )", True),
    # sets, in any order, each part used once
    ("{2,1}", "{1,2}", True), ("{1,1,2}", "{1,2,2}", False), ("{1,2.0,2}", "{2,2,1}", True),
    ("{(2,1.0),a}", "{a,(2,1)}", True), ("{{2,1},{3}}", "{{3.0},{1,2}}", True),
    # numbers, absolute tolerance
    ("0.50", ".5", True), ("+3.", "3", True), ("5.0000000005", "5", True), ("5.00000001", "5", False),
    ("٣", "3", True),
    # text behind one pair of parentheses
    ("(5)", "5", True), ("x+1", "(x+1)", True),
    # no rule
    ("5", "x=5", False), ("90", r"90^\circ", False), ("-2,1", "1,-2", False), ("[1,2]", "[2,1]", False),
    (r"\frac{1}{2}", "0.5", False),
]


def pairs(spark):
    rows = [(i, p, g) for i, (p, g, _) in enumerate(TABLE)]
    return spark.createDataFrame(rows, "i INT, pred STRING, gold STRING")


def test_rules_as_column(spark):
    rows = pairs(spark).select("i", answers_match(F.col("pred"), F.col("gold")).alias("ok")).collect()
    wrong = [TABLE[r.i] for r in rows if r.ok is not TABLE[r.i][2]]
    assert not wrong


def test_rules_as_operator(spark):
    rows = with_match(pairs(spark), "pred", "gold", "ok").collect()
    wrong = [TABLE[r.i] for r in rows if r.ok != int(TABLE[r.i][2])]
    assert not wrong and rows[0].__fields__ == ["i", "pred", "gold", "ok"]


def test_every_answer_agrees_with_itself(spark):
    texts = sorted({t for p, g, _ in TABLE for t in (p, g) if t and t.strip()})
    df = spark.createDataFrame([(t, f" {t} ") for t in texts], "pred STRING, gold STRING")
    assert with_match(df, "pred", "gold", "ok").filter("ok = 0").count() == 0


def test_sets_against_brute_force(spark):
    import itertools
    import random

    rng = random.Random(1)
    values = ["1", "1.0", "2", "x+1", "(1,2)", "(1.0,2)"]
    classes = {"1": "1", "1.0": "1", "2": "2", "x+1": "x", "(1,2)": "t", "(1.0,2)": "t"}
    rows = []
    for size in (2, 3, 4):
        for _ in range(60):
            p, g = (rng.choices(values, k=size) for _ in range(2))
            agrees = any(
                all(classes[a] == classes[b] for a, b in zip(p, order))
                for order in itertools.permutations(g)
            )
            rows.append((f"{{{','.join(p)}}}", f"{{{','.join(g)}}}", int(agrees)))
    df = spark.createDataFrame(rows, "pred STRING, gold STRING, want INT")
    assert with_match(df, "pred", "gold", "ok").filter("ok <> want").collect() == []


@pytest.fixture(scope="module")
def golden(spark):
    rows = [
        (n_mcmc, gold, pred, grade)
        for n_mcmc, graded in ROWS.items()
        for gold, pred, grade in graded
    ]
    return spark.createDataFrame(rows, "n_mcmc INT, gold STRING, pred STRING, published INT")


def test_published_grades(golden):
    graded = with_match(golden, "pred", "gold", "ok")
    assert graded.count() == 120
    assert graded.filter("ok <> published").collect() == []


def test_published_sweep(golden):
    from answerloom.operators.metrics import sweep_accuracy

    graded = with_match(golden, "pred", "gold", "correct_eval")
    got = {r.n_mcmc: (r.n, r.accuracy_pct) for r in sweep_accuracy(graded).collect()}
    want = {1: 20, 2: 21, 3: 21, 4: 22}
    assert got == {k: (30, pytest.approx(100 * c / 30)) for k, c in want.items()}


RUNS = [
    ("base", 0, "e1", r"So \boxed{4}.", "4"),
    ("base", 1, "e1", "Answer: 5", "4"),
    ("base", 1, "e1", "Answer: 5", "4"),
    ("base", 0, "e2", "", "4"),
    ("base", 0, "e2", None, "4"),
    ("power_mh", 0, "e1", "#### 4.0", "4"),
    ("power_mh", 0, "e3", r"\boxed{(1, 2.0)}", "(1,2)"),
    ("power_mh", 0, "e3", r"\boxed{7}", None),
]


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        RUNS, "method STRING, seed INT, example_id STRING, completion STRING, gold STRING"
    )


def test_grade_runs(runs):
    rows = grade_runs(runs).collect()
    assert [(r.pred_eval, r.correct_eval) for r in rows] == [
        ("4", 1), ("5", 0), ("5", 0), ("", 0), ("", 0), ("4.0", 1), ("(1, 2.0)", 1), ("7", 0),
    ]


def test_grading_once_per_pair_changes_nothing(runs):
    def key(rows):
        return sorted(map(str, rows))

    once = grade_runs_once_per_pair(runs)
    assert once.columns == grade_runs(runs).columns
    assert key(once.collect()) == key(grade_runs(runs).collect())
    counts = correct_counts_once_per_pair(runs, "method").collect()
    assert sorted((r.method, r.n, r.c) for r in counts) == [("base", 5, 1), ("power_mh", 3, 2)]


def test_simple_grading(spark, runs):
    rows = grade_runs_simple(runs).collect()
    assert [(r.pred, r.correct) for r in rows] == [
        ("4", 1), ("5", 0), ("5", 0), ("", 0), ("", 0), ("4.0", 0), ("(1, 2.0)", 0), ("7", 0),
    ]
    df = spark.createDataFrame([("(7)", "7"), (r"\frac{1}{2}", r"$\frac{1}{2}$"), ("a", "b")], "p STRING, g STRING")
    assert [r.x for r in df.select(simple_match(F.col("p"), F.col("g")).alias("x")).collect()] == [True, True, False]
