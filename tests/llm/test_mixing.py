import hashlib
from collections import Counter, defaultdict

import pytest

from answerloom.llm import mixing
from answerloom.llm.oracles import MIX_SOURCES
from tests.llm import cases


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """The excess is given out again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, full, target = share * sum(sizes.values()), set(), {}
    while True:
        rest = [s for s in order if s not in full]
        level = (left - sum(cap * sizes[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        target = {s: cap * sizes[s] if s in full else level * weight[s] for s in order}
        above = {s for s in rest if target[s] > cap * sizes[s]}
        if not above:
            return target
        full |= above


def slow_seats(targets, seats):
    """One seat at a time."""
    won = [0] * len(targets)
    for _ in range(seats):
        best = max(range(len(targets)), key=lambda k: (targets[k] / (2 * won[k] + 1), -k))
        won[best] += 1
    return won


def test_targets_and_takings(spark):
    got = mixing.mix(cases.documents(spark)).collect()
    rows = cases.rows()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(cases.words(r[1]))
    target = slow_targets(sizes)
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == Counter(
        (r[0], len(cases.words(r[1])), sizes[r[3]]) for r in rows
    )
    taken = defaultdict(int)
    for r in got:
        assert float(r.target) == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r["size"] and r.lang == "en" and r.fp == 7
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 16
    again = mixing.mix(cases.documents(spark).repartition(6)).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))


def test_seats_one_by_one(spark):
    for targets in ([5.0, 5.0, 5.0], [1000.0, 1.0, 0.4, 37.5, 37.5], [3.0], [53.2, 24.1, 15.7, 7.0]):
        for seats in (1, 2, 7, 30, 111):
            parties = spark.createDataFrame(
                [(k, t, [seats, seats + 5]) for k, t in enumerate(targets)], "rank int, target double, houses array<long>"
            )
            got = defaultdict(dict)
            for r in mixing.apportion(parties).collect():
                got[r.house][r["rank"]] = r.seats
            for house in (seats, seats + 5):
                assert [got[house].get(k, 0) for k in range(len(targets))] == slow_seats(targets, house)


def test_shard_quotas_add_up(spark):
    targets = spark.createDataFrame([(0, 700.0), (1, 200.0), (2, 100.0)], "rank int, target double")
    rows = mixing.shard_quotas(targets, block_words=1, shards=16).collect()
    per_shard = Counter()
    for r in rows:
        assert r.quota >= 0
        per_shard[r.shard] += r.quota
    assert [per_shard[k] for k in range(16)] == [63] * 15 + [55]
    last = {r["rank"]: r.through for r in rows if r.shard == 15}
    assert last == {0: 700, 1: 200, 2: 100}


def test_take_repeats_documents(spark):
    docs = spark.createDataFrame([(k, "w " * 100, "a" if k < 2 else "b") for k in range(10)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs).collect()
    got = mixing.take(docs, shard="part")
    assert got.columns == [*docs.columns, "part"]
    assert Counter((r.doc_id, r.part) for r in got.collect()) == Counter((r.doc_id, s) for r in mixed for s in r.shards)
    assert all(len(r.shards) == r.passes for r in mixed)


def test_shards_take_their_quotas(spark):
    """Word by word: a shard's words of a source are its quota of blocks."""
    docs = spark.createDataFrame(
        [(k, "w " * (k % 37), "abc"[k % 3]) for k in range(400)], "doc_id long, text string, source string"
    )
    mixed = mixing.mix(docs, shards=5).collect()
    targets = slow_targets({s: sum(r["size"] for r in mixed if r.source == s) for s in "abc"})
    blocks = round(sum(targets.values()) / 16)
    each = -(-blocks // 5)
    through = [slow_seats([targets[s] for s in "abc"], min((k + 1) * each, blocks)) for k in range(5)]
    for at, source in enumerate("abc"):
        line = sorted(
            (r for r in mixed if r.source == source), key=lambda r: hashlib.md5(f"7:{r.doc_id}".encode()).hexdigest()
        )
        start = 0
        size = sum(r["size"] for r in line)
        for r in line:
            blocks_before = [(turn * size + start) // 16 for turn in range(r.passes)]
            assert r.shards == [sum(t[at] <= b for t in through) for b in blocks_before]
            start += r["size"]


def test_take_keeps_columns_of_any_name(spark):
    docs = cases.documents(spark).withColumnsRenamed({"leaks": "passes", "votes": "row", "taken": "shards", "bucket": "source_size"})
    got = mixing.take(docs)
    assert got.schema == docs.schema and set(map(str, got.collect())) <= set(map(str, docs.collect()))


def test_no_documents_or_no_words(spark):
    assert mixing.mix(cases.empty(spark)).collect() == []
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken, r.passes) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0, 0)] * 2


def test_oracle_text_has_the_parameters_of_the_query():
    assert "target / 16" in MIX_SOURCES and "'7:'" in MIX_SOURCES
