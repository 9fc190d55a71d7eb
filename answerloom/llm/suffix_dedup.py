"""Removal of long byte strings that an earlier document holds too, by distributed prefix doubling.

Names of substrings are doubled as in prefix doubling: the name of 2n bytes at a
position is the pair of the names of n bytes there and n bytes further on.
Positions whose name no other document has are out; the others go on to longer
names until the threshold is reached.

1. Texts are packed into batches.  Names of 1, 2, 4, 8, 16 and ``GRAM`` bytes are
   doubled within a task.  Of every ``LENGTH``-byte string the position of its
   least ``GRAM``-byte name is its anchor: equal strings have equal anchors, so
   one position stands for all strings that share it.
2. Spark deals out the anchors' names by range and finds those that occur in two
   documents or more.  A bit per name goes back to each batch.
3. Anchors that are left send the bytes around them, once for equal
   surroundings in a batch; their names grow by a byte at a time on either side
   to all ``LENGTH``-byte strings with this anchor.  Names are sorted with their
   documents; what a smaller doc_id has too is marked and goes back as a mask.
4. Each batch removes the bytes under marked strings.

No row stands for a byte, and no group leaves more than one row in a batch, so
a string that half of all documents hold is as cheap as any other.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.common import land

LENGTH = 50
GRAM = 24
#: Bytes of text in a batch; a longer document is a batch of its own.
BATCH_BYTES = 1 << 20
#: Anchors whose strings are named at a time; those with equal grams stay together.
CHUNK = 1 << 15
#: Bytes of text whose names are doubled at a time: whole documents up to about this size.
BLOCK_BYTES = 1 << 18
_NAME_BITS = 48


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


_BASE = 0x9E3779B97F4A7C15


def gram_names(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Name of the ``gram`` bytes at each position, by doubling."""
    names, size = _mix(data.astype(np.uint64) + np.uint64(1)), 1
    parts, total = None, 0  # the name of the lowest bits of ``gram`` so far
    rest = gram
    while rest:
        if rest & 1:
            if parts is None:
                parts, total = names, size
            else:
                count = len(data) - total - size + 1
                if count <= 0:
                    return np.empty(0, np.uint64)
                parts, total = parts[:count] * _power(_BASE, size) + names[total : total + count], total + size
        rest >>= 1
        if rest:
            count = len(names) - size
            if count <= 0:
                return np.empty(0, np.uint64)
            names, size = names[:count] * _power(_BASE, size) + names[size : size + count], size * 2
    return _mix(parts)


class Anchors:
    """The anchors of a batch: position, name, first and last string of each."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> None:
        self.length, self.gram, self.side = length, gram, length - gram
        starts = np.r_[0, ends[:-1]] if len(ends) else ends
        count = len(data) - length + 1
        self.names = np.empty(0, np.uint64)
        self.at = self.low = self.high = np.empty(0, np.int64)
        if count <= 0:
            return
        names = gram_names(data, gram)
        # Least name of the grams in each string, the leftmost of equals: the position is in the low half.
        order = (names & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(names), dtype=np.uint64)
        least, width = order, 1
        while width * 2 <= self.side + 1:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        if (more := self.side + 1 - width) > 0:
            least = np.minimum(least[: len(least) - more], least[more:])
        inside = np.zeros(count + 1, np.int32)  # strings that lie within one document
        fits = ends - starts >= length
        np.add.at(inside, starts[fits], 1)
        np.add.at(inside, ends[fits] - length + 1, -1)
        valid = np.flatnonzero(np.cumsum(inside[:count]) > 0)
        if not len(valid):
            return
        chosen = (least[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        self.at = chosen[first]
        self.low = valid[first]
        self.high = valid[np.r_[first[1:], len(valid)] - 1]
        # Anchors have the least names of their strings; mixed again, names spread evenly over the ranges.
        self.names = _mix(names[self.at] + np.uint64(_BASE))

    def moved(self, by: int) -> Anchors:
        self.at, self.low, self.high = self.at + by, self.low + by, self.high + by
        return self

    @classmethod
    def joined(cls, parts: list[Anchors], length: int, gram: int) -> Anchors:
        whole = cls(np.empty(0, np.uint8), np.empty(0, np.int64), length, gram)
        for name in ("names", "at", "low", "high") if parts else ():
            setattr(whole, name, np.concatenate([getattr(p, name) for p in parts]))
        return whole

    def keep(self, which: np.ndarray) -> None:
        self.at, self.low, self.high, self.names = (x[which] for x in (self.at, self.low, self.high, self.names))

    def sides(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes before and behind each anchor's gram that its strings reach; others are 0."""
        reach = np.arange(1, self.side + 1)
        padded = np.concatenate([np.zeros(self.side, np.uint8), data, np.zeros(self.side, np.uint8)])
        before = padded[self.side + self.at[:, None] - reach]
        behind = padded[self.side + self.at[:, None] + self.gram - 1 + reach]
        before[reach > (self.at - self.low)[:, None]] = 0
        behind[reach > (self.high + self.length - self.at - self.gram)[:, None]] = 0
        return before, behind


def _short(names: np.ndarray) -> np.ndarray:
    return names >> np.uint64(64 - _NAME_BITS)


def _bucket(short: np.ndarray, buckets: int) -> np.ndarray:
    return ((short * np.uint64(buckets)) >> np.uint64(_NAME_BITS)).astype(np.int64)


def _pieces(sorted_buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    starts = np.flatnonzero(np.r_[True, sorted_buckets[1:] != sorted_buckets[:-1]]) if len(sorted_buckets) else []
    for k, start in enumerate(starts):
        end = starts[k + 1] if k + 1 < len(starts) else len(sorted_buckets)
        yield int(sorted_buckets[start]), slice(int(start), int(end))


def _zip(data: np.ndarray | bytes) -> bytes:
    raw = data if isinstance(data, bytes) else np.ascontiguousarray(data).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unzip(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _split_bytes(values: np.ndarray) -> bytes:
    """Sorted values as differences, byte by byte place, which packs well."""
    steps = np.diff(values, prepend=np.uint64(0))
    return _zip(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.copy())


def _join_bytes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(_unzip(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view("<u8").reshape(-1).astype(np.uint64), dtype=np.uint64)


PACKED = "batch long, ids binary, sizes binary, texts binary"


def pack(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Documents in batches, compressed; a batch never splits one.  Nothing is shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0

        def row() -> pa.RecordBatch:
            nonlocal task, held
            cells = [task, _zip(np.array(ids, "<i8")), _zip(np.array([len(t) for t in texts], "<i8")), _zip(b"".join(texts))]
            task, held = task + 1, 0
            ids.clear()
            texts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int64() if k == 0 else pa.binary()) for k, c in enumerate(cells)],
                ["batch", "ids", "sizes", "texts"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                data = text.as_py() or b""
                if ids and held + len(data) > batch_bytes:
                    yield row()
                ids.append((1 << 63) - 1 if doc_id is None else doc_id)
                texts.append(data)
                held += len(data)
        if ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long"), F.encode("text", "utf-8").alias("text"))
    return rows.mapInArrow(run, PACKED)


class Batch:
    """An unpacked batch with its anchors and their distinct names."""

    def __init__(self, ids: bytes, sizes: bytes, texts: bytes, length: int = LENGTH, gram: int = GRAM) -> None:
        self.ids = np.frombuffer(_unzip(ids), "<i8")
        self.ends = np.cumsum(np.frombuffer(_unzip(sizes), "<i8"))
        self.data = np.frombuffer(_unzip(texts), np.uint8)
        self.anchors = self._anchors(length, gram)
        self.short, self.of = np.unique(_short(self.anchors.names), return_inverse=True)

    def _anchors(self, length: int, gram: int) -> Anchors:
        found, first, start = [], 0, 0
        while first < len(self.ends):
            last = max(first + 1, int(np.searchsorted(self.ends, start + BLOCK_BYTES, side="right")))
            end = int(self.ends[last - 1])
            found.append(Anchors(self.data[start:end], self.ends[first:last] - start, length, gram).moved(start))
            first, start = last, end
        return Anchors.joined(found, length, gram)

    def docs(self) -> np.ndarray:
        """doc_id at each anchor."""
        return self.ids[np.searchsorted(self.ends, self.anchors.at, side="right")]

    def in_two_documents(self) -> np.ndarray:
        """For each distinct name, whether two doc_ids of this batch have it."""
        docs = self.docs()
        low = np.full(len(self.short), np.iinfo(np.int64).max)
        high = np.full(len(self.short), np.iinfo(np.int64).min)
        np.minimum.at(low, self.of, docs)
        np.maximum.at(high, self.of, docs)
        return high > low

    def survivors(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keep the anchors with shared names.  Returns (before, behind) of each, its class of equal surroundings, and
        for each class the anchor that stands for it, one in a document with the smallest id."""
        anchors = self.anchors
        anchors.keep(shared[self.of])
        before, behind = anchors.sides(self.data)
        name = anchors.names.copy()
        spans = np.stack([anchors.at - anchors.low, anchors.high - anchors.at + LENGTH], 1).astype(np.uint64)
        for column in (*before.T, *behind.T, *spans.T):
            name = name * np.uint64(_BASE) + column + np.uint64(1)
        order = np.lexsort((self.docs(), _mix(name)))
        sorted_names = _mix(name)[order]
        first = np.r_[True, sorted_names[1:] != sorted_names[:-1]] if len(order) else np.empty(0, bool)
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(first) - 1
        return before, behind, kind, order[first]


def _release() -> None:
    """Give freed memory back: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, Batch]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            yield row, Batch(row["ids"], row["sizes"], row.pop("texts"))
            _release()


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """All rows of a bucket, bucket by bucket, of a sorted partition."""
    held: list[dict] = []
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            if held and held[0]["bucket"] != row["bucket"]:
                yield held
                held = []
                _release()
            held.append(row)
    if held:
        yield held


def shared_names(packed: DataFrame, buckets: int) -> DataFrame:
    """batch, bucket, data: a bit for each distinct anchor name of the batch in the bucket, set if two documents have it."""
    sent = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("names", pa.binary()), ("twice", pa.binary())])
    reply = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, batch in _unpacked(batches):
            twice = batch.in_two_documents()
            yield _out(
                [
                    (b, row["batch"], _split_bytes(batch.short[part]), np.packbits(twice[part]).tobytes())
                    for b, part in _pieces(_bucket(batch.short, buckets))
                ],
                sent,
            )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches):
            names = [_join_bytes(r["names"]) for r in rows]
            twice = [np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(n)) for r, n in zip(rows, names)]
            # Names are distinct within a batch, so a name that comes twice is in two batches.
            _, of, count = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)
            found = (count > 1)[of] | (np.bincount(of, np.concatenate(twice)) > 0)[of]
            cuts = np.cumsum([len(n) for n in names])[:-1]
            bits = np.split(found, cuts)
            yield _out([(r["batch"], r["bucket"], np.packbits(x).tobytes()) for r, x in zip(rows, bits)], reply)

    return (
        packed.mapInArrow(send, "bucket int, batch long, names binary, twice binary")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "batch")
        .mapInArrow(compare, "batch long, bucket int, data binary")
    )


def marked_strings(packed: DataFrame, shared: DataFrame, buckets: int) -> DataFrame:
    """batch, bucket, data: positions of representative anchors and masks of their strings that a smaller doc_id has."""
    sent = pa.schema(
        [("bucket", pa.int32()), ("batch", pa.int64()), ("at", pa.binary()), ("names", pa.binary()), ("docs", pa.binary()),
         ("reach", pa.binary()), ("sides", pa.binary())]
    )
    reply = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])
    side = LENGTH - GRAM

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, batch in _unpacked(batches):
            before, behind, _, chosen = batch.survivors(_bits(row["shared"], batch, buckets))
            anchors = batch.anchors
            to = _bucket(_short(anchors.names[chosen]), buckets)
            order = np.argsort(to, kind="stable")
            chosen, to, docs = chosen[order], to[order], batch.docs()
            rows = []
            for b, part in _pieces(to):
                k = chosen[part]
                reach = np.stack([anchors.at[k] - anchors.high[k], anchors.at[k] - anchors.low[k]]).astype(np.int8)
                rows.append(
                    (
                        b, row["batch"], _zip(anchors.at[k].astype("<u4")), _zip(anchors.names[k]), _zip(docs[k]), _zip(reach),
                        _zip(np.concatenate([before[k], behind[k]], axis=1)),
                    )
                )
            yield _out(rows, sent)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches):
            at = [np.frombuffer(_unzip(r["at"]), "<u4") for r in rows]
            names, docs = (
                np.concatenate([np.frombuffer(_unzip(r[c]), t) for r in rows]) for c, t in (("names", np.uint64), ("docs", "<i8"))
            )
            reach = np.concatenate([np.frombuffer(_unzip(r["reach"]), np.int8).reshape(2, -1) for r in rows], axis=1)
            sides = np.concatenate([np.frombuffer(_unzip(r["sides"]), np.uint8).reshape(-1, 2 * side) for r in rows])
            masks = string_masks(names, docs, reach, sides)
            cuts = np.cumsum([len(a) for a in at])[:-1]
            found = []
            for r, where, mask in zip(rows, at, np.split(masks, cuts)):
                hit = np.flatnonzero(mask)
                if len(hit):
                    found.append((r["batch"], r["bucket"], _zip(np.concatenate([where[hit], mask[hit].astype("<u4")]))))
            yield _out(found, reply)

    return (
        packed.join(_gathered(shared, "shared"), "batch")
        .mapInArrow(send, "bucket int, batch long, at binary, names binary, docs binary, reach binary, sides binary")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "batch")
        .mapInArrow(compare, "batch long, bucket int, data binary")
    )


def string_masks(names: np.ndarray, docs: np.ndarray, reach: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Bit t of an anchor's mask: the string that starts t bytes before it is also in a document with a smaller id."""
    masks = np.zeros(len(names), np.uint32)
    order = np.argsort(names, kind="stable")
    sorted_names = names[order]
    start = 0
    while start < len(order):
        end = min(start + CHUNK, len(order))
        end = int(np.searchsorted(sorted_names, sorted_names[end - 1], side="right"))
        part = order[start:end]
        masks[part] = _masks(names[part], docs[part], reach[:, part], sides[part])
        start = end
    return masks


def _masks(names: np.ndarray, docs: np.ndarray, reach: np.ndarray, sides: np.ndarray) -> np.ndarray:
    side = LENGTH - GRAM
    masks = np.zeros(len(names), np.uint32)
    tails = [np.zeros(len(names), np.uint64)]
    for k in range(side):
        tails.append(tails[-1] * np.uint64(_BASE) + _mix(sides[:, side + k].astype(np.uint64) + np.uint64(300)))
    head = np.zeros(len(names), np.uint64)
    for t in range(side + 1):
        if t:
            head = head * np.uint64(_BASE) + _mix(sides[:, t - 1].astype(np.uint64) + np.uint64(1))
        has = np.flatnonzero((reach[0] <= t) & (t <= reach[1]))
        name = _mix(_mix(names[has] + head[has]) ^ tails[side - t][has])
        order = np.lexsort((docs[has], name))
        sorted_names, sorted_docs = name[order], docs[has][order]
        first = np.r_[True, sorted_names[1:] != sorted_names[:-1]] if len(order) else np.empty(0, bool)
        smallest = sorted_docs[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        masks[has[order[sorted_docs > smallest]]] |= np.uint32(1 << t)
    return masks


def _gathered(replies: DataFrame, name: str) -> DataFrame:
    """One row per batch with what the buckets have sent back, at most one entry for each."""
    return replies.groupBy("batch").agg(F.collect_list(F.struct("bucket", "data")).alias(name))


def _bits(parts: list[dict] | None, batch: Batch, buckets: int) -> np.ndarray:
    by_bucket = {p["bucket"]: p["data"] for p in parts or ()}
    shared = np.zeros(len(batch.short), bool)
    for b, part in _pieces(_bucket(batch.short, buckets)):
        shared[part] = np.unpackbits(np.frombuffer(by_bucket[b], np.uint8), count=part.stop - part.start).astype(bool)
    return shared


def removed_spans(batch: Batch, shared: np.ndarray, marked: list[dict] | None) -> np.ndarray:
    """For each byte of the batch, whether it is to be removed."""
    _, _, kind, chosen = batch.survivors(shared)
    anchors, docs = batch.anchors, batch.docs()
    mask_at = dict()
    for part in marked or ():
        raw = np.frombuffer(_unzip(part["data"]), "<u4").reshape(2, -1)
        mask_at.update(zip(raw[0].tolist(), raw[1].tolist()))
    of_class = np.array([mask_at.get(int(a), 0) for a in anchors.at[chosen]], np.uint64)
    masks = of_class[kind] if len(kind) else np.empty(0, np.uint64)
    # Equal surroundings in a larger document of the same batch: all strings are in the representative's document.
    if len(kind):
        masks[docs > docs[chosen][kind]] = np.uint64(0xFFFFFFFF)
    change = np.zeros(len(batch.data) + 1, np.int32)
    for t in range(LENGTH - GRAM + 1):
        start = anchors.at - t
        hit = start[(start >= anchors.low) & (start <= anchors.high) & ((masks >> np.uint64(t)) & np.uint64(1)).astype(bool)]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


RESULT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def remove_repeats(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_bytes, ``spans`` (maximal removed runs of bytes, ends exclusive) and ``kept`` (the bytes that stay).

    One row for each row of ``docs`` (doc_id: a whole number, text).  A byte
    goes if a ``LENGTH``-byte string over it also starts in a document with a
    smaller doc_id; strings are judged on the input and never cross documents.
    NULL texts are empty; texts below ``LENGTH`` bytes stay whole.  A NULL
    doc_id is larger than any other.  Rows with the same doc_id are one
    document to each other, so what only they share stays.  Other columns are
    not read; an empty table gives no rows.  ``buckets``: ranges of names that
    are compared apart, by default two per shuffle partition.
    """
    spark = docs.sparkSession
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = land(pack(docs), "repeats-packed")
    shared = land(shared_names(packed, buckets), "repeats-shared")
    marked = land(marked_strings(packed, shared, buckets), "repeats-marked")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()),
         ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
    )

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, batch in _unpacked(batches):
            gone = removed_spans(batch, _bits(row["shared"], batch, buckets), row["marked"])
            rows, start = [], 0
            for doc_id, end in zip(batch.ids.tolist(), batch.ends.tolist()):
                own = gone[start:end]
                edges = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                kept = batch.data[start:end][~own].tobytes()
                rows.append((None if doc_id == (1 << 63) - 1 else doc_id, end - start, spans, kept))
                start = end
            yield _out(rows, schema)

    replies = _gathered(shared, "shared").join(_gathered(marked, "marked"), "batch", "left")
    return packed.join(replies, "batch", "left").mapInArrow(finish, RESULT)


def digest(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
