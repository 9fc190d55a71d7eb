"""The manifest against a plain recomputation, and its proofs."""

import hashlib
import random
import zlib
from collections import Counter

import pytest

from answerloom.llm import merkle
from answerloom.llm.common import scratch_path
from tests.llm import cases


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(digests):
    found = [digests]
    while len(found[-1]) > 1:
        found.append([sha(*found[-1][i : i + 8]) for i in range(0, len(found[-1]), 8)])
    return found


def way(tree, i):
    """(siblings, place) of each level."""
    steps = []
    for level in tree[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        steps.append((run[: i % 8] + run[i % 8 + 1 :], i % 8))
        i //= 8
    return steps


def leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [levels([leaf(r) for r in groups[g]]) for g in order]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = way(trees[k], i) + way(top, k)
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for siblings, place in steps:
                node = sha(*siblings[:place], node, *siblings[place:])
            proof = sha(*(s for siblings, _ in steps for s in siblings))
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return Counter(out)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    got = merkle.digest(df)
    assert got.columns == COLUMNS
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_odd_documents(spark):
    docs = cases.documents(spark)
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert Counter(map(tuple, merkle.digest(docs).collect())) == brute(rows)


@pytest.mark.parametrize("sizes", [(1,), (8,), (9, 1), (64, 65, 1), (3, 600, 7, 1, 2, 8, 5, 4, 3, 2)])
def test_sizes_around_the_fan(spark, sizes):
    rows = []
    for k, size in enumerate(sizes):
        lang = None if k == 1 else f"é{k}"
        rows += [(1000 * k + i * 7, "s", lang, i, f"Text {i % 5} Ab") for i in range(size)]
    check(spark, rows)


def test_repeated_rows(spark):
    check(spark, [(1, "a", "en", 3, "Same")] * 20 + [(1, "a", "en", 3, "other"), (None, None, None, None, None)])


def test_empty(spark):
    got = merkle.digest(cases.empty(spark))
    assert got.columns == COLUMNS and got.collect() == []


def test_some_requests_and_records(spark):
    pick = random.Random(3)
    rows = [(f"g{pick.randrange(3)}", i, sha(str(i)), f"tag {i}") for i in range(300)]
    path = scratch_path(spark, "test-merkle")
    manifest = merkle.write(spark.createDataFrame(rows, "grp string, ord long, leaf string, tag string"), path)
    for tree, height in (("lower", manifest.height), ("upper", manifest.upper_height)):
        for k in range(1, height + 1):
            for r in manifest.records(tree, k).collect():
                assert r.digest == sha(*r.children)
    chosen = manifest.leaves().filter("ord % 17 = 3").select("grp", "idx", "leaf", "tag")
    proven = merkle.prove(manifest, chosen)
    rows = proven.withColumn("again", merkle.fold(proven["leaf"], proven["segments"], proven["digits"])).collect()
    assert len(rows) == chosen.count() == 18
    assert all(r.found == r.leaf and r.again == manifest.root for r in rows)
    missing = spark.createDataFrame([("g1", 100_000, "x", "x"), ("nobody", 0, "x", "x")], "grp string, idx long, leaf string, tag string")
    assert merkle.prove(manifest, missing).collect() == []
