import math
import random

import pytest
from pyspark.sql import functions as F

from answerloom.functions.estimators import pass_at_k
from answerloom.operators.metrics import (
    accuracy_by,
    accuracy_cube,
    accuracy_overall,
    distinct_examples,
    method_series,
    scores_summary,
)
from answerloom.operators.passk import (
    outcome_counts,
    pass_at_k_curve,
    pass_at_k_grid,
    pass_at_k_per_example,
)

SCHEMA = "method STRING, seed INT, example_id STRING, correct_eval INT"
# Correct answers out of 100 per method and seed.  Only the totals per method and per seed are published;
# the split between them is made up to fit.
PUBLISHED = {"base": (62, 62, 62), "lowtemp": (67, 68, 67), "power_mh": (72, 71, 67)}


@pytest.fixture(scope="module")
def published(spark):
    rows = [
        (method, seed, f"e{i}", int(i < correct))
        for method, per_seed in PUBLISHED.items()
        for seed, correct in enumerate(per_seed)
        for i in range(100)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_published_scores(published):
    (row,) = scores_summary(published).collect()
    assert row.n == 900 and row.accuracy == 598 / 900
    assert row.accuracy_by_method == {"base": 0.62, "lowtemp": 202 / 300, "power_mh": 0.7}
    assert row.accuracy_by_seed == {"0": 0.67, "1": 0.67, "2": 196 / 300}
    assert distinct_examples(published).collect() == [(100,)]


def test_cube_equals_the_single_aggregates(published):
    cube = {(r.level, r.key): (r.n, r.accuracy) for r in accuracy_cube(published).collect()}
    assert cube.pop(("all", None)) == tuple(accuracy_overall(published).head())
    for key in ("method", "seed"):
        for r in accuracy_by(published, key).collect():
            n, accuracy = cube.pop((key, str(r[key])))
            assert n == r.n and accuracy == pytest.approx(r.accuracy)
    assert not cube


def test_missing_keys_leave_the_groups_only(spark):
    df = spark.createDataFrame(
        [("base", None, "a", 1), (None, 1, "a", 0), (None, None, None, 1)], SCHEMA
    )
    (row,) = scores_summary(df).collect()
    assert (row.n, row.accuracy) == (3, 2 / 3)
    assert (row.accuracy_by_method, row.accuracy_by_seed) == ({"base": 1.0}, {"1": 0.0})
    assert accuracy_by(df, "method").collect() == [("base", 1, 1.0)]
    assert outcome_counts(df).collect() == [("base", "a", 1, 1)]
    assert distinct_examples(df).collect() == [(1,)]


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert accuracy_overall(empty).collect() == [(0, 0.0)]
    assert scores_summary(empty).collect() == [(0, 0.0, {}, {})]
    assert accuracy_by(empty, "seed").collect() == []
    assert [r.accuracy_pct for r in method_series(empty).orderBy("position").collect()] == [0.0] * 3
    assert pass_at_k_curve(outcome_counts(empty), 3).collect() == []


def test_method_series_is_complete_and_ordered(published):
    rows = method_series(published, ["power_mh", "other", "base"]).orderBy("position").collect()
    assert [(r.method, r.accuracy_pct) for r in rows] == [
        ("power_mh", pytest.approx(70)), ("other", 0.0), ("base", pytest.approx(62)),
    ]


def estimate(n, c, k):
    return None if n < k else 1 - math.comb(n - c, k) / math.comb(n, k)


def test_pass_at_k_equals_combinatorics(spark):
    cases = [(n, c, k) for n in range(13) for c in range(n + 1) for k in range(1, 14)]
    df = spark.createDataFrame(cases, "n LONG, c LONG, k INT")
    rows = df.select("n", "c", "k", pass_at_k(F.col("n"), F.col("c"), F.col("k")).alias("v")).collect()
    for n, c, k, v in rows:
        want = estimate(n, c, k)
        assert v is None if want is None else v == pytest.approx(want, abs=1e-12)


def test_pass_at_k_of_a_very_hot_example(spark):
    """A third of a huge table on one example: neither long lists nor overflow."""
    n, c = 3_000_000_000_000, 1_000_000_000_000
    df = spark.createDataFrame([(n, c, 8), (n, 2, 1_000_000)], "n LONG, c LONG, k INT")
    hot, rare = [r[0] for r in df.select(pass_at_k(F.col("n"), F.col("c"), F.col("k"))).collect()]
    assert hot == pytest.approx(1 - (2 / 3) ** 8, abs=1e-9)
    assert rare == pytest.approx(2e6 / n, rel=1e-3)


def test_curve_against_lists_of_outcomes(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["a", "b", "c"]), rng.randint(0, 9), f"e{int(rng.paretovariate(0.7)) % 40}", rng.randint(0, 1))
        for _ in range(2000)
    ]
    counts = outcome_counts(spark.createDataFrame(rows, SCHEMA)).cache()
    lists = {}
    for method, _, example, correct in rows:
        lists.setdefault((method, example), []).append(correct)
    assert {(r.method, r.example_id): (r.n, r.c) for r in counts.collect()} == {
        key: (len(v), sum(v)) for key, v in lists.items()
    }
    max_k = 60
    want = {}
    for method in "abc":
        for k in range(1, max_k + 1):
            values = [
                estimate(len(v), sum(v), k) for (m, _), v in lists.items() if m == method and len(v) >= k
            ]
            want[method, k] = sum(values) / len(values) if values else None
    grid = {(r.method, r.k): r.pass_at_k for r in pass_at_k_grid(counts, max_k).collect()}
    assert grid.keys() == want.keys()
    assert all(grid[p] == pytest.approx(v) if v is not None else grid[p] is None for p, v in want.items())
    curve = {(r.method, r.k): r.pass_at_k for r in pass_at_k_curve(counts, max_k).collect()}
    assert curve.keys() == {p for p, v in want.items() if v is not None}
    per_example = pass_at_k_per_example(counts, 5).collect()
    assert len(per_example) == 5 * len(lists)
    by_example = {}
    for r in per_example:
        if r.pass_at_k is not None:
            assert 0 <= r.pass_at_k <= 1
            by_example.setdefault((r.method, r.example_id), []).append((r.k, r.pass_at_k))
        if r.k == 1:
            assert r.pass_at_k == pytest.approx(r.c / r.n)
    for values in by_example.values():
        values = [v for _, v in sorted(values)]
        assert all(a <= b + 1e-12 for a, b in zip(values, values[1:]))
