import hashlib
import random
from collections import Counter

import numpy as np

from answerloom.llm import suffix_dedup
from tests.llm import cases


def slow(rows, length=50):
    """A byte goes if a string over it is in a document with a smaller id; NULL is the largest id."""
    key = lambda i: 2**63 - 1 if i is None else i
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            s = data[k : k + length]
            first[s] = min(first.get(s, key(doc_id)), key(doc_id))
    out = Counter()
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            if first[data[k : k + length]] < key(doc_id):
                gone[k : k + length] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        out[(doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def planted(seed):
    pick = random.Random(seed)
    text = lambda n: "".join(pick.choice("ab c") for _ in range(n))
    shared = [text(n) for n in (49, 50, 51, 75, 76, 77, 120, 300)]
    rows = []
    for k in range(60):
        parts = [pick.choice(shared)[pick.randrange(3) :] if pick.random() < 0.5 else text(pick.randrange(0, 60)) for _ in range(6)]
        rows.append((pick.randrange(40), "".join(parts)))
    rows += [(100 + k, "z" * pick.randrange(40, 200)) for k in range(8)] + [(120, "xyz" * 80), (121, "yzx" * 60), (122, "é" * 60)]
    rows += [(130 + k, rows[k][1][: len(rows[k][1]) // 2] + rows[k + 1][1]) for k in range(20)]
    return rows


def run(spark, rows, parts=4, buckets=None, monkeypatch=None):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return Counter(map(tuple, suffix_dedup.digest(df).collect()))


def test_against_all_strings(spark):
    rows = [(r[0], r[1]) for r in cases.rows()]
    assert Counter(map(tuple, suffix_dedup.digest(cases.documents(spark)).collect())) == slow(rows)


def test_planted_repeats(spark, monkeypatch):
    for seed in (1, 2):
        rows = planted(seed)
        assert run(spark, rows) == slow(rows)
    monkeypatch.setattr(suffix_dedup, "pack", lambda docs, batch_bytes=400, pack=suffix_dedup.pack: pack(docs, batch_bytes))
    assert run(spark, rows, 2) == slow(rows)  # many batches, several in a task


def test_buckets_do_not_matter(spark):
    rows = planted(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    few, many = (
        Counter((r.doc_id, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df, b).collect()) for b in (1, 23)
    )
    assert few == many


def test_names_are_names_of_content():
    data = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789" * 3, np.uint8)
    names = suffix_dedup.gram_names(data)
    assert len(names) == len(data) - 23
    assert all((names[k] == names[0]) == (k % 36 == 0) for k in range(len(names)))


def test_empty(spark):
    assert suffix_dedup.digest(cases.empty(spark)).collect() == []
    assert run(spark, [(1, None), (2, "")]) == slow([(1, None), (2, "")])
