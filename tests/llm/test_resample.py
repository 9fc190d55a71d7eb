"""N-gram CRCs from prefixes, and the draw, against plain recomputation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from answerloom.llm import resample
from tests.llm import cases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, tests):
    """docs: (doc_id, text)."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in tests:
        t.update(features(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10_000) / ((s[b] + 1.0) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        found = features(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    enough = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for place, r in enumerate(enough[: 5 * len(enough) // 100], 1):
        r[4] = place
    return Counter(tuple(r[:5]) for r in rows)


def check(docs, benchmark):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    tests = [r.text for r in benchmark.collect()]
    got = resample.digest(docs, benchmark)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {d for _, d in got.dtypes} == {"bigint"}
    assert Counter(map(tuple, got.collect())) == brute(rows, tests)


@pytest.fixture()
def benchmark(spark):
    rows = [(k, cases.prose(30, 50 + k)) for k in range(20)] + [(98, None), (99, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_odd_documents(spark, benchmark):
    check(cases.documents(spark), benchmark)


def test_many_documents(spark, benchmark):
    pick = random.Random(5)
    rows = [(k, cases.prose(pick.randrange(60), k)) for k in range(300)] + [(7, cases.prose(40, 1))] * 2
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), benchmark)


def test_empty_tables(spark, benchmark):
    none = cases.empty(spark)
    assert resample.digest(none, benchmark).collect() == []
    check(cases.documents(spark), benchmark.filter("false"))


def test_keep_drawn(spark, benchmark):
    docs = spark.createDataFrame([(k, cases.prose(25, k), k) for k in range(60)], "doc_id long, text string, drawn_id long")
    kept = resample.keep_drawn(docs, benchmark, percent=10)
    want = resample.resample(docs, benchmark, percent=10).filter("rank is not null").select("doc_id")
    assert kept.columns == docs.columns and kept.count() == 6
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in want.collect()}


def test_shifts():
    pick = random.Random(1)
    lengths = [0, 1, 2, 255, 256, 257, 511, 512, 70_001, *(pick.randrange(3000) for _ in range(200))]
    data = [(pick.randbytes(5), pick.randbytes(n)) for n in lengths]
    heads = np.array([zlib.crc32(a) for a, _ in data], np.uint32)
    shifted = resample.Shifts()(heads, np.array(lengths, np.int64))
    for (a, b), moved in zip(data, shifted.tolist()):
        assert zlib.crc32(a + b) ^ moved == zlib.crc32(b)


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 20])
def test_pieces_do_not_matter(monkeypatch, piece):
    monkeypatch.setattr(resample, "PIECE", piece)
    pick = random.Random(piece)
    texts = [cases.prose(pick.randrange(40), k) for k in range(12)] + ["", "  ", "é" * 400 + " A1 " + "x" * 300, "one", None, "a b"]
    shifts = resample.Shifts()
    found = [Counter() for _ in texts]
    counted = [0] * len(texts)
    for scan in resample.scans(None if t is None else t.encode() for t in texts):
        for at in scan.owner[scan.lead :].tolist():
            counted[at] += 1
        for n in (1, 2, 3):
            crcs, last = scan.grams(n, shifts)
            for crc, at in zip(crcs.tolist(), scan.owner[last].tolist()):
                found[at][crc % 10_000] += 1
    assert found == [Counter(features(t)) for t in texts]
    assert counted == [len(words(t)) for t in texts]
