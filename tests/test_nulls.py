"""One rule for NULL keys and grades."""

from answerloom.operators import metrics
from answerloom.operators.sampler import carried_state
from tests.test_sampler import SCHEMA


def test_a_null_grade_is_left_out_everywhere(spark):
    rows = [("base", 0, 1), ("base", 0, None), ("base", 1, 0), ("mh", 1, None), (None, 0, 1), ("base", None, 1)]
    df = spark.createDataFrame(rows, "method string, seed int, correct_eval int")
    cube = {(r.level, r.key): (r.n, r.accuracy) for r in metrics.accuracy_cube(df).collect()}
    assert cube[("all", None)] == (6, 0.75) == tuple(metrics.accuracy_overall(df).first())
    for r in metrics.accuracy_by(df, "method").collect():
        assert cube[("method", r.method)] == (r.n, r.accuracy)
    for r in metrics.accuracy_by(df, "seed").collect():
        assert cube[("seed", str(r.seed))] == (r.n, r.accuracy)
    assert cube[("method", "mh")] == (1, None)


def test_no_row_of_a_chain_without_keys_is_lost(spark):
    rows = [
        (1, None, 0, 4.0, -1.0, -2.0, 0.0, 0.0, 0.5), (None, 1, 0, 4.0, -1.0, -2.0, 0.0, 0.0, 0.5),
        (1, None, 1, 4.0, -9.0, -1.0, 0.0, 0.0, 0.5), (1, 1, None, 4.0, -1.0, -2.0, 0.0, 0.0, 0.5),
    ]
    got = {(r.chain_id, r.block, r.step): (r.expected_logp, r.consistent) for r in carried_state(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, None, 0): (-2.0, True), (1, None, 1): (-1.0, True), (None, 1, 0): (-2.0, True), (1, 1, None): (-2.0, True)}


def test_sparse_step_numbers_are_cut_by_count(spark):
    rows = [(1, 1, k * 10**12, 4.0, -1.0, -2.0 if k == 0 else -1.0, 0.0, 0.0, 0.5) for k in range(100)]
    assert carried_state(spark.createDataFrame(rows, SCHEMA), 10).filter("consistent").count() == 100
