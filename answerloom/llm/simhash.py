"""Near-duplicates by SimHash: pigeonhole blocks, then verified Hamming distances."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.common import land
from answerloom.llm.components import components

SHINGLE_WORDS = 4
DISTANCE = 4
#: Fingerprints are cut into this many blocks; at most ``DISTANCE`` of them can differ in a link.
BLOCKS = 6
#: Bit counts are taken over this many shingles at a time, whatever the length of the text.
CHUNK = 1 << 16
#: Buckets up to this size are compared all at once with the others, larger ones by search.
SMALL_BUCKET = 32

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint_of(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of one text; 0 without a word."""
    # bytes.split() cuts at exactly the six ASCII white space characters.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < size:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    ones = np.zeros(64, np.int64)
    total = len(words) - size + 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, total, CHUNK):
        part = words[start : start + CHUNK + size - 1]
        hashes = np.array([digest(join(s), 42) for s in zip(*(part[k:] for k in range(size)))], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, ``text_hash`` (XXH64 of the text) and ``fp`` (the SimHash as BIGINT); narrow, nothing shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint_of(t.as_py(), size) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.array(values, np.uint64).view(np.int64))],
                ["doc_id", "text_hash", "fp"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """Masks of all sets of ``blocks - distance`` blocks: a pair within the distance agrees on at least one set."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    parts = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[list[int], list[int]]:
    """The pairs that join parts which earlier pairs have not joined yet."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    kept: tuple[list[int], list[int]] = ([], [])
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept[0].append(a)
            kept[1].append(b)
    return kept


def _search(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that reach all of a bucket's connected fingerprints; a dense bucket is done after a few comparisons."""
    left, right = [], []
    rest = values
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count(rest ^ at) <= distance
            found = rest[near]
            if len(found):
                left.append(np.full(len(found), at))
                right.append(found)
                frontier.extend(found)
                rest = rest[~near]
    if not left:
        return values[:0], values[:0]
    return np.concatenate(left), np.concatenate(right)


def bucket_links(bucket: np.ndarray, fp: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links within buckets; ``bucket`` is sorted."""
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, len(bucket)])
    left, right = [fp[:0]], [fp[:0]]
    at = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL_BUCKET), sizes))
    for lag in range(1, SMALL_BUCKET):
        at = at[at + lag < len(bucket)]
        at = at[bucket[at] == bucket[at + lag]]
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= distance]
        left.append(fp[near])
        right.append(fp[near + lag])
    for k in np.flatnonzero(sizes > SMALL_BUCKET):
        a, b = _search(fp[starts[k] : starts[k] + sizes[k]], distance)
        left.append(a)
        right.append(b)
    return _forest(np.concatenate(left), np.concatenate(right))


def hamming_links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """``prints`` (fp, distinct) -> links (a, b) that connect exactly what Hamming distances up to ``distance`` connect.

    Each fingerprint goes to one bucket for every choice of ``blocks - distance``
    blocks.  Buckets are sorted runs of 8-byte values in a partition; a task
    holds one bucket and a few Arrow batches at a time, compares with XOR and
    population count, and gives a spanning forest, so the links stay in
    proportion to the fingerprints even where all are alike.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int64), np.empty(0, np.uint64))

        def links(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = bucket_links(bucket, fp, distance)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"]
            )

        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0
        for batch in batches:
            waiting.append((batch.column("bucket").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)))
            count += batch.num_rows
            if count < (1 << 18):
                continue
            bucket = np.concatenate([held[0], *(w[0] for w in waiting)])
            fp = np.concatenate([held[1], *(w[1] for w in waiting)])
            waiting, count = [], 0
            cut = np.searchsorted(bucket, bucket[-1])  # the last bucket may go on in the next batch
            held = (bucket[cut:], fp[cut:])
            yield links(bucket[:cut], fp[:cut])
        bucket = np.concatenate([held[0], *(w[0] for w in waiting)])
        yield links(bucket, np.concatenate([held[1], *(w[1] for w in waiting)]))

    def key(k: int, mask: int) -> Column:
        signed = mask - (1 << 64) if mask >> 63 else mask
        return F.xxhash64(F.col("fp").bitwiseAND(F.lit(signed)), F.lit(k))  # a clash only adds a comparison

    keys = F.array(*(key(k, mask) for k, mask in enumerate(block_masks(blocks, distance))))
    return (
        prints.select("fp", F.explode(keys).alias("bucket"))
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(run, "a long, b long")
    )


def classes(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``prints`` (doc_id, fp, ...) -> fp, root (one fp per class), component_id (smallest doc_id of the class)."""
    distinct = land(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(hamming_links(distinct.select("fp"), distance), "simhash-links")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return land(rooted.join(firsts, "root").select("fp", "root", "component_id"), "simhash-classes")


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """doc_id, text_hash, fp, root, component_id for each row of ``docs`` (doc_id, text).

    NULL and texts without a word have the fingerprint zero and link like any
    other.  Exact copies share a fingerprint, so however many there are, they
    are one value in the search.  Repeated rows each give a row.  A NULL doc_id
    is never the smallest; ``component_id`` is NULL where a class has no other.
    Extra columns of ``docs`` are not read.
    """
    prints = land(fingerprints(docs, size), "simhash-prints")
    return prints.join(classes(prints, distance), "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_first(docs: DataFrame, classed: DataFrame) -> DataFrame:
    """Of each class of ``classed`` (doc_id, text_hash, root, component_id) the row of ``docs`` with the smallest doc_id."""
    chosen = (
        classed.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("_kept"))
        .select(F.col("_kept.doc_id").alias("_id"), F.col("_kept.text_hash").alias("_hash"))
    )
    # The row travels as one value, so no column of it can clash with those of the work.
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct("*").alias("row"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return rows.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "text_hash"]).select("row.*")


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) that stay: of each class one, with the smallest doc_id, as it is.

    NULL, empty and blank texts are one class together with all that their
    fingerprint zero links.  Rows that agree in doc_id and text are one row
    afterwards; of rows that agree in doc_id alone the text's hash decides.  A
    class without any doc_id keeps one row.  Long texts are read whole; columns
    of any name stay; an empty table stays empty.
    """
    return keep_first(docs, near_duplicates(docs, size, distance))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
