import math
import random

import numpy as np
import pytest

from answerloom.operators.sampler import (
    accept_rate,
    block_schedule,
    carried_state,
    replay,
    summary,
    thresholds,
    walk,
    with_acceptance,
)

SCHEMA = (
    "chain_id LONG, block LONG, step LONG, alpha DOUBLE, prop_logp DOUBLE, cur_logp DOUBLE,"
    " logq_old DOUBLE, logq_new DOUBLE, u DOUBLE"
)


def simulated_log(chains):
    """A log as a sampler would write it, with the states it went through."""
    rng = random.Random(11)
    rows, states, accepted = [], {}, {}
    for chain, steps in chains.items():
        accepted[chain] = 0
        for block in (1, 2):
            current = rng.uniform(-50, -10)
            for step in range(steps):
                proposed = current + rng.uniform(-3, 3)
                old, new, u = (rng.uniform(-2, 0) for _ in range(2)), None, rng.random()
                old, new = old
                rows.append((chain, block, step, 4.0, proposed, current, old, new, u))
                states[chain, block, step] = current
                if math.log(u) < min(0.0, 4.0 * (proposed - current) + (old - new)):
                    current = proposed
                    accepted[chain] += 1
    return rows, states, accepted


@pytest.fixture(scope="module")
def log():
    return simulated_log({1: 900, 2: 7, 3: 1})


@pytest.mark.parametrize("segment", [1, 10, 64, 100_000])
def test_state_is_replayed_across_segments(spark, log, segment):
    rows, states, _ = log
    replayed = carried_state(spark.createDataFrame(rows, SCHEMA).repartition(5), segment).collect()
    assert len(replayed) == len(rows)
    for r in replayed:
        assert r.consistent and r.expected_logp == states[r.chain_id, r.block, r.step]


def test_a_tampered_log_is_found(spark, log):
    rows = list(log[0])
    at = 450
    row = list(rows[at])
    row[5] += 0.5
    rows[at] = tuple(row)
    bad = carried_state(spark.createDataFrame(rows, SCHEMA), 50).filter("not consistent")
    assert (row[0], row[1], row[2]) in [(r.chain_id, r.block, r.step) for r in bad.collect()]


def test_accept_rate(spark, log):
    rows, _, accepted = log
    got = {r.chain_id: r for r in accept_rate(spark.createDataFrame(rows, SCHEMA)).collect()}
    for chain, steps in {1: 1800, 2: 14, 3: 2}.items():
        assert (got[chain].n_steps, got[chain].n_accepted) == (steps, accepted[chain])
        assert got[chain].accept_rate == pytest.approx(accepted[chain] / steps)


def test_acceptance_at_the_edges(spark):
    rows = [
        (1, 1, 0, 4.0, -1.0, -1.0, 0.0, 0.0, 0.999),  # ratio 0: always
        (1, 1, 1, 4.0, -9.0, -1.0, 0.0, 0.0, 0.5),
        (1, 1, 2, 4.0, -9.0, -1.0, 0.0, 0.0, 0.0),  # u = 0: ln is minus infinity
        (1, 1, 3, 4.0, float("-inf"), -1.0, 0.0, 0.0, 0.0),
    ]
    got = with_acceptance(spark.createDataFrame(rows, SCHEMA)).orderBy("step").collect()
    assert [r.accepted for r in got] == [True, False, True, False]


def test_block_schedule(spark):
    df = spark.createDataFrame([("a", 400), ("b", 192), ("c", 1), ("d", 0)], "id STRING, length LONG")
    got = sorted((r.id, r.block, r.block_end) for r in block_schedule(df, 192).collect())
    assert got == [("a", 1, 192), ("a", 2, 384), ("a", 3, 400), ("b", 1, 192), ("c", 1, 1)]


@pytest.mark.parametrize("segment", [1, 7, 64, 100_000])
def test_replay_does_not_look_at_the_logged_states(spark, log, segment):
    """Only the first value of a block counts; all others are noise here."""
    rows, states, accepted = log
    pick = random.Random(1)
    blind = [(*r[:5], r[5] if r[2] == 0 else pick.uniform(-99, 99), *r[6:]) for r in rows]
    got = replay(spark.createDataFrame(blind, SCHEMA).repartition(5), segment)
    assert got.columns == [c.split()[0] for c in SCHEMA.split(", ")] + ["replay_logp", "replay_accepted"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.replay_logp == states[r.chain_id, r.block, r.step]
    assert sum(r.replay_accepted for r in got) == sum(accepted.values())


def direct(x, alpha, prop, dq, u):
    figures = (alpha, prop, dq, u)
    if any(f is None or math.isnan(f) for f in figures):
        return False
    la = alpha * (prop - x) + dq
    return la > -math.inf if u <= 0 else math.log(u) < min(0.0, la)


def test_summaries_and_walks_against_single_steps():
    """Signs of alpha, zero, missing figures and draws at the edges, from many entry states."""
    pick = random.Random(8)
    for trial in range(300):
        n = pick.randrange(1, 12)
        rows = [
            (
                pick.choice([4.0, 1.0, 0.5, 0.0, -1.0]) if trial % 2 else 2.0, pick.choice([pick.uniform(-5, 5), -3.0, float("nan")]),
                pick.uniform(-2, 2), pick.choice([pick.random(), pick.random() * 0.01, 0.0, 1.0, float("nan")]),
            )
            for _ in range(n)
        ]
        alpha, prop, dq, u = (np.array(c, float) for c in zip(*rows))
        bound, side = thresholds(alpha, prop, dq, u)
        sides, bounds, leaves = summary(prop, bound, side)
        for x in [pick.uniform(-8, 8) for _ in range(6)] + [-100.0, 100.0]:
            state, before = x, []
            for r in rows:
                before.append(state)
                if direct(state, *r):
                    state = r[1]
            assert walk(x, prop, bound, side).tolist() == [*before, state]
            hit = [v for s, t, v in zip(sides, bounds, leaves) if (x < t if s > 0 else x > t)]
            assert (hit[0] if hit else x) == state


def test_replay_of_odd_rows(spark):
    none = None
    rows = [
        (none, none, 1, 2.0, -1.0, -5.0, 0.0, 0.0, 0.5),
        (none, none, 2, 2.0, none, -9.0, 0.0, 0.0, 0.5),
        (1, 1, none, 2.0, -2.0, none, 0.0, 0.0, 0.5),
        (1, 1, 5, 2.0, -1.0, -7.0, 0.0, 0.0, 0.5),
    ]
    got = {(r.chain_id, r.step): (r.replay_logp, r.replay_accepted) for r in replay(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(none, 1): (-5.0, True), (none, 2): (-1.0, False), (1, none): (none, False), (1, 5): (none, False)}
    assert replay(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("segment", [1, 3, 40, 100_000])
def test_replay_of_many_short_blocks_runs_over_batches(spark, segment):
    """Blocks of one to three rows: a Python call for each would take a millisecond a row; a long block among them crosses segments."""
    pick = random.Random(5)
    rows, want = [], {}
    for chain in range(900):
        for block in (None, 2):
            x = pick.uniform(-5, 5)
            for step in range(300 if chain == 450 else pick.randrange(1, 4)):
                prop, u = pick.uniform(-5, 5), pick.random()
                rows.append((chain, block, step, 2.0, prop, x if step == 0 else 99.0, 0.0, 0.0, u))
                want[chain, block, step] = (x, direct(x, 2.0, prop, 0.0, u))
                x = prop if direct(x, 2.0, prop, 0.0, u) else x
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        replayed = replay(spark.createDataFrame(rows, SCHEMA), segment)
        assert "InArrow" in replayed._jdf.queryExecution().toString() and "FlatMap" not in replayed._jdf.queryExecution().toString()
        got = {(r.chain_id, r.block, r.step): (r.replay_logp, r.replay_accepted) for r in replayed.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want
