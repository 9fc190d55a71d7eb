"""Benchmark decontamination by greedy string tiling.

Documents are joined with the tests on shared seeds of five words.  For each
document and test that share one, the longest non-overlapping matches are
marked again and again, found by running Karp-Rabin hashes over windows of
shrinking length, until no match of the least length is left.  The share of the
test's words under tiles decides, so a passage whose parts were put in another
order is caught like one that was copied whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from answerloom.llm.common import land, spare_name

MIN_MATCH = 5
COVERAGE = 0.6
#: Words of the tests that one pass over the documents looks for; more tests take more passes.
BLOCK_WORDS = 1_000_000

_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _window_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every window."""
    count = len(ids) - length + 1
    hashes = np.zeros(max(0, count), np.uint64)
    for k in range(length if count > 0 else 0):
        hashes = hashes * _BASE + ids[k : k + count]
    return hashes


def tile(test: Sequence[int], doc: Sequence[int], least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (start in test, start in doc, length) of the greedy tiling, in the order they were marked.

    Ids below 1 match nothing.  Ties go to the earlier start in the test, then
    in the document.
    """
    least = min(least, len(test))
    if not least:
        return []
    free_test, free_doc = [t > 0 for t in test], [d > 0 for d in doc]
    tiles: list[tuple[int, int, int]] = []
    modulus, base = (1 << 61) - 1, 1_000_003

    def windows(ids: Sequence[int], free: list[bool], length: int):
        """Start and rolling hash of each window without a marked word."""
        drop, value, run = pow(base, length - 1, modulus), 0, 0
        for k, x in enumerate(ids):
            if not free[k]:
                value = run = 0
                continue
            if run >= length:
                value = (value - ids[k - length] * drop) % modulus
            value = (value * base + x) % modulus
            run += 1
            if run >= length:
                yield k - length + 1, value

    length = max(least, len(test) // 2)
    while True:
        starts = defaultdict(list)
        for at, value in windows(test, free_test, length):
            starts[value].append(at)
        matches, longest = [], 0
        for d, value in windows(doc, free_doc, length):
            for t in starts.get(value, ()):
                if t and d and test[t - 1] == doc[d - 1] and free_test[t - 1] and free_doc[d - 1]:
                    continue  # part of the match that starts one word earlier
                k = 0
                while (
                    t + k < len(test) and d + k < len(doc)
                    and test[t + k] == doc[d + k] and free_test[t + k] and free_doc[d + k]
                ):
                    k += 1
                if k >= length:
                    matches.append((-k, t, d))
                    longest = max(longest, k)
        if longest > 2 * length:  # a far longer match than expected: look at its length first
            length = longest
            continue
        heapify(matches)
        while matches:
            k, t, d = heappop(matches)
            free = [free_test[t + j] and free_doc[d + j] for j in range(-k)]
            if all(free):
                free_test[t : t - k] = free_doc[d : d - k] = [False] * -k
                tiles.append((t, d, -k))
                continue
            start = 0
            for j in range(-k + 1):  # what longer tiles have left of it waits for its turn
                if j == -k or not free[j]:
                    if j - start >= length:
                        heappush(matches, (start - j, t + start, d + start))
                    start = j + 1
        if length == least:
            return tiles
        length = max(least, length // 2)


class Tests:
    """Some tests with their vocabulary and seeds; small enough to send to every task."""

    def __init__(self, rows: Sequence[tuple], least: int = MIN_MATCH, coverage: float = COVERAGE) -> None:
        self.least, self.coverage = least, coverage
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[object, list[int]]] = []
        seeds: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in rows:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens(text)]
            if ids:
                length = min(least, len(ids))
                for value in _window_hashes(np.array(ids, np.uint64), length).tolist():
                    seeds[length][value].add(len(self.items))
                self.items.append((item_id, ids))
        self.seeds = {n: (np.array(sorted(found), np.uint64), dict(found)) for n, found in seeds.items()}

    def leaks(self, text: str | None) -> list[dict]:
        """The tests that the text covers, each with its coverage and tiles (in words of test and text)."""
        ids = np.array([self.vocabulary.get(w, 0) for w in tokens(text)], np.uint64)
        spots: dict[int, set[int]] = defaultdict(set)
        for length, (sorted_seeds, items) in self.seeds.items():
            hashes = _window_hashes(ids, length)
            if not len(hashes):
                continue
            near = np.minimum(np.searchsorted(sorted_seeds, hashes), len(sorted_seeds) - 1)
            for at in np.flatnonzero(sorted_seeds[near] == hashes).tolist():
                for item in items[int(hashes[at])]:
                    spots[item].update(range(at, at + length))
        found = []
        for item in sorted(spots):
            item_id, test = self.items[item]
            where, doc = [], []
            for at in sorted(spots[item]):  # only words under a seed can be in a tile
                if where and at != where[-1] + 1:
                    where.append(-1)
                    doc.append(0)
                where.append(at)
                doc.append(int(ids[at]))
            tiles = tile(test, doc, self.least)
            covered = sum(k for _, _, k in tiles) / len(test)
            if covered >= self.coverage:
                found.append(
                    {
                        "item_id": item_id,
                        "coverage": covered,
                        "tiles": [{"test_start": t, "doc_start": where[d], "words": k} for t, d, k in sorted(tiles)],
                    }
                )
        return found


def leaks(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = MIN_MATCH, block_words: int | None = None
) -> DataFrame:
    """Add ``leaks`` to ``docs`` (text): the tests of ``benchmark`` (item_id, text) that the document covers.

    An array of (item_id, coverage, tiles), empty for a clean document.  Tests
    go to the tasks in blocks of about ``block_words`` (``BLOCK_WORDS``) words.  Each block is a
    pass of its own over the texts, whose result is written before the next one
    starts, so a task never holds more than one; documents are not shuffled.  Seeds and
    tiles have ``least`` words, or as many as the test has if it is shorter.
    Tests without a word (NULL, empty, signs only) match nothing; NULL and
    empty documents are clean.  A test given twice is reported twice.  A column
    ``leaks`` in ``docs`` is replaced.
    """
    spark = docs.sparkSession
    id_type = benchmark.schema["item_id"].dataType
    arrow_id = to_arrow_type(id_type)
    result = (
        f"array<struct<item_id:{id_type.simpleString()},coverage:double,"
        "tiles:array<struct<test_start:int,doc_start:int,words:int>>>>"
    )
    tests = benchmark.select("item_id", "text")
    size = tests.agg(F.sum(F.regexp_count("text", F.lit(r"(?U)\w+")))).first()[0] or 0  # words as ``tokens`` sees them
    blocks = -(-int(size) // (block_words or BLOCK_WORDS)) or 1

    def search(block: int) -> Column:
        rows = tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast(vars(Tests([tuple(r) for r in rows.collect()], least, coverage)))

        @F.arrow_udf(result)
        def run(texts: pa.Array) -> pa.Array:
            known = Tests.__new__(Tests)
            vars(known).update(sent.value)
            kind = pa.list_(
                pa.struct(
                    [
                        ("item_id", arrow_id),
                        ("coverage", pa.float64()),
                        ("tiles", pa.list_(pa.struct([(n, pa.int32()) for n in ("test_start", "doc_start", "words")]))),
                    ]
                )
            )
            return pa.array([known.leaks(t.as_py()) for t in texts], kind)

        return run(F.col("text"))

    found = docs.withColumn("leaks", search(0))
    for block in range(1, blocks):
        found = land(found, "leaks-block").withColumn("leaks", F.concat("leaks", search(block)))
    return found


def leak_rows(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row for each document and test that it covers: doc_id, item_id, coverage, n_tiles, longest_tile.

    NULL, empty and blank texts cover nothing and have no row; long texts are
    searched whole; repeated rows and tests are each reported; a text at exactly
    ``coverage`` covers the test.  Other columns are not read; an empty table of
    either kind gives no rows.
    """
    found = leaks(docs.select("doc_id", "text"), benchmark, coverage)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id",
        "leak.item_id",
        "leak.coverage",
        F.size("leak.tiles").alias("n_tiles"),
        F.array_max("leak.tiles.words").alias("longest_tile"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` (text, ...) that cover no test of ``benchmark``, as they are.

    NULL, empty and blank texts are clean.  Repeated rows stay or go together,
    long texts are read whole, columns of any name stay, and an empty table or
    benchmark changes nothing.
    """
    own = spare_name(docs.columns, "own_leaks")
    named = docs.withColumnRenamed("leaks", own)
    clean = leaks(named, benchmark, coverage).filter(F.size("leaks") == 0).drop("leaks")
    return clean.withColumnRenamed(own, "leaks").select(*docs.columns)
