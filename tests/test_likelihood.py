import random

import numpy as np
import pytest

from answerloom.operators.likelihood import (
    average_entropy,
    sequence_logprob,
    suffix_logprob,
    with_token_entropy,
    with_token_logprob,
)

SCHEMA = "seq_id LONG, pos INT, target INT, logits ARRAY<DOUBLE>, prompt_len INT"
LENGTHS = {1: (6, 2), 2: (4, 0), 3: (3, 5), 4: (1, 1)}


@pytest.fixture(scope="module")
def sequences():
    rng = np.random.default_rng(0)
    return {
        seq: (rng.normal(0, 30, (length, 50)), rng.integers(0, 50, length), prompt)
        for seq, (length, prompt) in LENGTHS.items()
    }


@pytest.fixture(scope="module")
def tokens(spark, sequences):
    rows = [
        (seq, pos, int(target[pos]), logits[pos].tolist(), prompt)
        for seq, (logits, target, prompt) in sequences.items()
        for pos in range(len(target))
    ]
    return spark.createDataFrame(rows, SCHEMA)


def log_softmax(logits, temperature=1.0):
    z = logits / max(temperature, 1e-8)
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


@pytest.mark.parametrize("temperature", [1.0, 0.25, 3.0])
def test_log_probabilities(tokens, sequences, temperature):
    lp = {
        seq: log_softmax(logits, temperature)[np.arange(len(target)), target]
        for seq, (logits, target, _) in sequences.items()
    }
    for r in with_token_logprob(tokens, temperature).collect():
        assert r.logprob == pytest.approx(lp[r.seq_id][r.pos], rel=1e-9, abs=1e-9)
    for r in sequence_logprob(tokens, temperature).collect():
        assert r.logprob == pytest.approx(lp[r.seq_id][1:].sum(), abs=1e-7)
    for r in suffix_logprob(tokens, temperature=temperature).collect():
        length, prompt = LENGTHS[r.seq_id]
        total = lp[r.seq_id][max(prompt, 1):].sum()
        assert r.n_tokens == max(length - prompt, 0)
        assert r.logprob_sum == pytest.approx(total, abs=1e-7)
        assert r.logprob_avg == pytest.approx(total / max(length - prompt, 1), abs=1e-7)


def test_entropy(tokens, sequences):
    for r in average_entropy(tokens).collect():
        logits, _, prompt = sequences[r.seq_id]
        p = log_softmax(logits)[max(prompt, 1):]
        want = -(np.exp(p) * p).sum(axis=1).mean() if len(p) else 0.0
        assert r.avg_entropy == pytest.approx(want, abs=1e-9)


def test_token_entropy(tokens, sequences):
    for r in with_token_entropy(tokens).collect():
        p = log_softmax(sequences[r.seq_id][0])[r.pos]
        assert r.entropy == pytest.approx(-(np.exp(p) * p).sum(), abs=1e-9)


def test_extreme_logits_do_not_overflow(spark):
    df = spark.createDataFrame([(1, 1, 0, [1e4, -1e4, 1e4], 0)], SCHEMA)
    assert with_token_logprob(df).head().logprob == pytest.approx(-np.log(2))
    assert average_entropy(df).head().avg_entropy == pytest.approx(np.log(2))


def test_repeated_keys_count_as_rows_of_their_own(spark):
    from answerloom.operators.likelihood import average_entropy, diagnostics

    df = spark.createDataFrame(
        [(1, 1, 0, [0.0, 0.0], 0)] * 2 + [(2, 0, 0, [0.0, 0.0], 0)], "seq_id LONG, pos INT, target INT, logits ARRAY<DOUBLE>, prompt_len INT"
    )
    import math

    got = {r.seq_id: r for r in diagnostics(df).collect()}
    assert abs(got[1].avg_entropy - math.log(2)) < 1e-12 and got[1].n_tokens == 2
    assert (got[2].avg_entropy, got[2].logprob_sum, got[2].n_tokens) == (0.0, 0.0, 1)
    plan = average_entropy(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan


def test_run_rows_keep_every_completion(spark):
    from answerloom.operators.likelihood import diagnostics
    from answerloom.operators.runs import run_rows
    from answerloom.operators.sampler import accept_rate

    runs = spark.createDataFrame(
        [("base", 1, 1), ("power_mh", 1, 1), ("power_mh", 9, None), (None, None, 9)], "method STRING, seq_id LONG, chain_id LONG"
    )
    tokens = spark.createDataFrame(
        [(1, 0, 0, [0.0, 0.0], 0), (1, 1, 0, [0.0, 0.0], 0)], "seq_id LONG, pos INT, target INT, logits ARRAY<DOUBLE>, prompt_len INT"
    )
    steps = spark.createDataFrame(
        [(1, 1, 0, 4.0, -1.0, -2.0, 0.0, 0.0, 0.5)],
        "chain_id LONG, block LONG, step LONG, alpha DOUBLE, prop_logp DOUBLE, cur_logp DOUBLE, logq_old DOUBLE, logq_new DOUBLE, u DOUBLE",
    )
    got = {(r.method, r.seq_id): r for r in run_rows(runs, diagnostics(tokens), accept_rate(steps)).collect()}
    assert len(got) == 4
    assert (got["base", 1].accept_rate, got["base", 1].num_tokens_generated) == (0.0, 2)
    assert (got["power_mh", 1].accept_rate, got["power_mh", 9].accept_rate, got["power_mh", 9].avg_entropy) == (1.0, 0.0, 0.0)


@pytest.mark.parametrize("temperature", [1.0, 0.25])
def test_both_forms_of_the_sums_agree(spark, temperature):
    """Column expressions and Arrow batches, on wide, narrow, empty and missing rows and targets out of range."""
    pick = random.Random(6)
    rows = [([pick.uniform(-30, 30) for _ in range(n)], pick.randrange(n)) for n in (1, 2, 7, 300, 5000) for _ in range(4)]
    rows += [(None, 0), ([1000.0, 999.0, -1000.0], 1), ([0.0] * 9, 8), ([1.0, 2.0], None)]
    df = spark.createDataFrame(rows, "logits array<double>, target int").repartition(3)
    both = with_token_logprob(df, temperature).withColumnRenamed("logprob", "a")
    both = with_token_logprob(both, temperature, arrow=True).withColumnRenamed("logprob", "b")
    both = with_token_entropy(both).withColumnRenamed("entropy", "c")
    for r in with_token_entropy(both, arrow=True).collect():
        assert (r.a is None, r.c is None) == (r.b is None, r.entropy is None)
        assert r.a is None or r.b == pytest.approx(r.a, rel=1e-9, abs=1e-9)
        assert r.c is None or r.entropy == pytest.approx(r.c, rel=1e-9, abs=1e-9)
