import random
from collections import Counter

import numpy as np
import xxhash

from answerloom.llm import simhash
from answerloom.llm.components import components
from tests.llm import cases


def slow_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = cases.words(lower)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(prints, distance=4):
    """Smallest index reachable over links, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))]


def test_spark_and_library_agree_on_the_hash(spark):
    text = "a short shingle é"
    got = spark.sql(f"select xxhash64('{text}') h").first().h
    assert got % 2**64 == xxhash.xxh64_intdigest(text.encode(), seed=42)


def test_against_all_pairs(spark):
    rows = cases.rows()
    got = simhash.digest(cases.documents(spark)).collect()
    prints = [slow_fingerprint(r[1]) for r in rows]
    roots = slow_classes(prints)
    smallest = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            smallest[root] = min(smallest.get(root, r[0]), r[0])
    want = Counter((r[0], f"{p:016x}", smallest.get(root)) for r, p, root in zip(rows, prints, roots))
    assert Counter(tuple(r) for r in got) == want


def test_long_texts_are_counted_in_chunks(monkeypatch):
    text = cases.prose(5000, 8)
    want = slow_fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert simhash.fingerprint_of(text) == want


def test_links_of_chains_and_large_buckets(spark):
    """Thousands of values around a few centres, chains of single steps, and lone values."""
    pick = random.Random(5)
    prints = set()
    for _ in range(3):
        centre = pick.getrandbits(64)
        for _ in range(400):
            prints.add(centre ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(5))))
    at = pick.getrandbits(64)
    for k in range(12):
        prints.add(at)
        at ^= 0b1111 << 4 * k
    prints |= {pick.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1, 2**63}
    prints = sorted(prints)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(5)
    links = simhash.hamming_links(df)
    assert links.count() <= len(simhash.block_masks()) * len(prints)
    found = {r.node: r.root for r in components(links).collect()}
    by_root, by_slow = {}, {}
    for k, p in enumerate(signed):
        by_root.setdefault(found.get(p, p), set()).add(k)
    for k, root in enumerate(slow_classes(prints)):
        by_slow.setdefault(root, set()).add(k)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_slow.values()))


def test_any_close_pair_shares_a_block():
    masks = simhash.block_masks()
    pick = random.Random(3)
    for _ in range(2000):
        flipped = sum(1 << b for b in pick.sample(range(64), 4))
        assert any(flipped & m == 0 for m in masks)


def test_keep_one(spark):
    docs = cases.documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [1, 4, 7, 9, 10, 11, 12, None] or ids == [1, 3, 4, 7, 9, 10, 11, 12, None]


def test_empty(spark):
    assert simhash.digest(cases.empty(spark)).collect() == []
    assert simhash.keep_one(cases.empty(spark)).collect() == []


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 160)]
    links = spark.createDataFrame(path + star + [(200, 200), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}
