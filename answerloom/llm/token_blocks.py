"""Token ids in binary files of patched frame-of-reference blocks.

The ids of all documents, one behind the other in the order of their doc_id,
are cut into blocks of ``BLOCK`` ids.  A block stores its minimum, the lowest
bits of every id's distance from it, as many as the given percentile of the
distances needs, and an exception list: place and remaining bits of the few
distances that need more.  An index of block starts and one of documents at the
end of a file lead to any document without reading the blocks before it.

A file, all numbers little-endian:

* ``PFORIDS1``
* blocks: ids (u32), exceptions (u32), minimum (u32), width (u32), packed bits, places (u32 each), remaining bits (u32 each)
* index: start of each block and the end of the last (u64 each)
* documents: doc_id (i64 each), whether it is set (u8 each), ids of it (u64 each)
* foot: number of blocks, of documents, of ids, start of the index (u64 each), ``PFORIDS1``
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from answerloom.llm.common import scratch_path

SCHEMA = "file string, doc_id long, start long, n_tokens long, ids array<int>, packed_ids binary"
MAGIC = b"PFORIDS1"
BLOCK = 1024
PERCENTILE = 0.9
#: Blocks are packed this many at a time.
TOGETHER = 256
#: Text encoded together, in characters, and text for one file, in bytes.
CALL_CHARS, FILE_BYTES = 1 << 18, 64 << 20
#: Stretches between spaces that a task remembers before it starts anew, those too long for it (from 1,024 bytes on
#: different texts could be made to share a name), and bytes named at once.
KNOWN, LONG, WINDOW = 1 << 20, 512, 1 << 20
_FOOT, _HEAD = "<QQQQ8s", "<IIII"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[a-z0-9+]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each of ``values`` needs."""
    return np.frexp(values.astype(np.float64))[1]


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """The blocks of ``ids`` (u32), a block to each row of the matrix."""
    count, size = ids.shape
    least = ids.min(axis=1)
    apart = ids - least[:, None]
    at = max(0, int(np.ceil(percentile * size)) - 1)
    width = _bits(np.partition(apart, at, axis=1)[:, at])
    blocks: list[bytes] = [b""] * count
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        part = apart[rows]
        bits = np.unpackbits(part.astype("<u4").view(np.uint8).reshape(len(rows), size, 4), axis=2, bitorder="little")
        packed = np.packbits(bits[:, :, :w].reshape(len(rows), -1), axis=1, bitorder="little")
        over = part >> np.uint32(w) if w < 32 else np.zeros_like(part)
        for k, row in enumerate(rows.tolist()):
            places = np.flatnonzero(over[k])
            blocks[row] = b"".join(
                (
                    struct.pack(_HEAD, size, len(places), int(least[row]), w), packed[k].tobytes(),
                    places.astype("<u4").tobytes(), over[k][places].astype("<u4").tobytes(),
                )
            )
    return blocks


def unpack(block: bytes) -> np.ndarray:
    size, exceptions, least, width = struct.unpack_from(_HEAD, block)
    at = struct.calcsize(_HEAD)
    length = -(-size * width // 8)
    bits = np.unpackbits(np.frombuffer(block, np.uint8, length, at), bitorder="little")[: size * width].reshape(size, width)
    whole = np.zeros((size, 32), np.uint8)
    whole[:, :width] = bits
    apart = np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()
    at += length
    places = np.frombuffer(block, "<u4", exceptions, at)
    apart[places] |= np.frombuffer(block, "<u4", exceptions, at + 4 * exceptions) << np.uint32(width % 32)
    return apart + np.uint32(least)


class _Known:
    """Numbers of 128-bit names, in the order of their first appearance: an open hash table over arrays."""

    def __init__(self, room: int) -> None:
        self.shift = np.uint64(64 - (2 * room - 1).bit_length())
        slots = 1 << (64 - int(self.shift))
        self.names = np.zeros((2, slots), np.uint64)
        self.number = np.full(slots, -1, np.int32)
        self.count = 0

    def _slots(self, first: np.ndarray) -> np.ndarray:
        return ((first * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The number of each name, -1 for those that have none."""
        found = np.full(len(first), -1, np.int64)
        slot, open_ = self._slots(first), np.arange(len(first))
        while len(open_):
            at = slot[open_]
            number = self.number[at]
            same = (self.names[0, at] == first[open_]) & (self.names[1, at] == second[open_]) & (number >= 0)
            found[open_[same]] = number[same]
            open_ = open_[~same & (number >= 0)]
            slot[open_] = (slot[open_] + 1) & (len(self.number) - 1)
        return found

    def add(self, first: np.ndarray, second: np.ndarray) -> None:
        """Number new names, all different, in their order."""
        numbers = np.arange(self.count, self.count + len(first), dtype=np.int32)
        self.count += len(first)
        slot, open_ = self._slots(first), np.arange(len(first))
        while len(open_):
            at = slot[open_]
            free = self.number[at] < 0
            self.number[at[free]] = numbers[open_[free]]
            won = free & (self.number[at] == numbers[open_])  # of several at one slot the last one written
            self.names[0, at[won]], self.names[1, at[won]] = first[open_[won]], second[open_[won]]
            open_ = open_[~won]
            slot[open_] = (slot[open_] + 1) & (len(self.number) - 1)


class _Names:
    """128-bit names of stretches of a text, all from one pass over it: differences of prefix sums of weighted bytes."""

    BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)

    def __init__(self) -> None:
        self.powers: list[tuple[np.ndarray, np.ndarray]] = []

    def _powers(self, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
        if not self.powers or len(self.powers[0][0]) < length:
            self.powers = []
            for base in self.BASES:
                both = []
                for factor in (base, pow(base, -1, 1 << 64)):
                    steps = np.full(length, factor, np.uint64)
                    steps[0] = 1
                    both.append(np.multiply.accumulate(steps))
                self.powers.append((both[0], both[1]))
        return self.powers

    def of(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
        values = data.astype(np.uint64) + np.uint64(1)
        names = []
        for power, inverse in self._powers(len(data) + 1):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values * power[: len(data)], out=sums[1:])
            names.append((sums[stops] - sums[starts]) * inverse[starts])
        # Low bits of such sums know little of far bytes; the length tells apart what ends alike.
        names[1] ^= (stops - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        return names


def _white(data: np.ndarray, at: np.ndarray, back: bool) -> np.ndarray:
    """Does a white space character end (``back``) or begin at these places? Both ends of ``data`` count as one."""
    inside = (at >= 0) & (at < len(data))
    byte = lambda k: np.where((at + k >= 0) & (at + k < len(data)), data[np.clip(at + k, 0, len(data) - 1)], 0x20)
    a, b, c = (byte(-2), byte(-1), byte(0)) if back else (byte(0), byte(1), byte(2))
    one = c if back else a
    two = (b, c) if back else (a, b)
    ascii_ = ((one >= 9) & (one <= 13)) | (one == 0x20) | ((one >= 0x1C) & (one <= 0x1F))
    latin = (two[0] == 0xC2) & ((two[1] == 0x85) | (two[1] == 0xA0))
    general = (a == 0xE2) & (
        ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F))
    )
    others = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    return ~inside | ascii_ | latin | general | others


def _among(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which ``values`` are among ``few``, a sorted array."""
    return few[np.minimum(np.searchsorted(few, values), len(few) - 1)] == values


class Coder:
    """Texts to ids: whole texts by a tokenizer file of the tokenizers library, without special tokens, and ``end``.

    A byte-level pre-tokenizer never carries a token over a single space between
    two other characters, so such a text is cut before each of them, and the
    library encodes each different stretch once for as long as it is remembered.
    Stretches are told apart by 128-bit names.  Other tokenizers get the texts as
    they are.
    """

    def __init__(self, path: str, end: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.end = np.array([end], np.uint32)
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        cut = kind.get("pre_tokenizer") or {}
        added = kind.get("added_tokens") or []
        self.spaced = (
            cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
            and not kind.get("normalizer") and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        vocabulary = self.coder.get_vocab(with_added_tokens=False)
        self.bytes = np.zeros(self.coder.get_vocab_size(with_added_tokens=True), np.int64)  # of each id
        self.bytes[list(vocabulary.values())] = list(map(len, vocabulary))  # a character stands for a byte
        for token in added:
            self.bytes[token["id"]] = len(token["content"].encode())
        self.names = _Names()
        self._forget()

    def _forget(self) -> None:
        self.known = _Known(KNOWN)
        self.ids = np.empty(1 << 16, np.uint32)  # of all stretches, one behind the other, with room to grow
        self.starts = np.zeros(1, np.int64)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.coder.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, ids: np.ndarray, stops: np.ndarray) -> None:
        """Ids of stretches that follow the last number, ending at ``stops`` of ``ids``."""
        used = int(self.starts[-1])
        if used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:used], np.empty(used + len(ids), np.uint32)])
        self.ids[used : used + len(ids)] = ids
        self.starts = np.concatenate([self.starts, used + stops])

    def _learn(self, stretches: list[bytes], apart: np.ndarray) -> None:
        """Encode new stretches, some hundred as one text: the bytes of its tokens tell where each begins.

        Those marked ``apart`` would touch their neighbours and are encoded alone.
        """
        ids: list[np.ndarray] = [np.empty(0, np.uint32)] * len(stretches)
        alone = np.flatnonzero(apart).tolist()
        for k, found in zip(alone, self._plain([stretches[k].decode() for k in alone])):
            ids[k] = found
        joined = np.flatnonzero(~apart)
        for first in range(0, len(joined), 512):
            part = [stretches[k] for k in joined[first : first + 512]]
            found = self._plain([b"".join(part).decode()])[0]
            token_ends, stops = np.cumsum(self.bytes[found]), np.cumsum([len(w) for w in part])
            upto = np.searchsorted(token_ends, stops, side="right")
            if not np.array_equal(token_ends[upto - 1], stops):
                raise ValueError("a token reaches over a space")
            for k, a, b in zip(joined[first : first + 512].tolist(), [0, *upto.tolist()], upto.tolist()):
                ids[k] = found[a:b]
        self._remember(np.concatenate(ids), np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))))

    def _numbers(self, raw: bytes, starts: np.ndarray, stops: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """The number of each stretch of ``raw``, new ones learned; stretches follow one another."""
        low = int(starts[0])
        data = np.frombuffer(raw, np.uint8, int(stops[-1]) - low, low)
        first, second = self.names.of(data, starts - low, stops - low)
        second[apart] ^= np.uint64(1)  # a stretch may be the same text with and without neighbours
        found = self.known.find(first, second)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            order = missing[np.lexsort((second[missing], first[missing]))]
            fresh = np.r_[True, (first[order[1:]] != first[order[:-1]]) | (second[order[1:]] != second[order[:-1]])]
            new = order[fresh]
            found[order] = self.known.count + np.cumsum(fresh) - 1
            self._learn([raw[a:b] for a, b in zip(starts[new].tolist(), stops[new].tolist())], apart[new])
            self.known.add(first[new], second[new])
        return found

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not self.spaced:
            return [np.concatenate([ids, self.end]) for ids in self._plain(texts)]
        parts = [t.encode() for t in texts]
        raw = b"".join(parts)
        begins = np.cumsum([0, *map(len, parts)])
        data = np.frombuffer(raw, np.uint8)
        spaces = np.flatnonzero(data == 0x20)
        spaces = spaces[~_white(data, spaces - 1, True) & ~_white(data, spaces + 1, False)]
        # A space that ends its text has nothing behind it, one that begins it nothing before.
        spaces = spaces[~_among(spaces, begins) & ~_among(spaces + 1, begins)]
        starts = np.sort(np.concatenate([spaces, begins[:-1][np.diff(begins) > 0]]), kind="stable")
        stops = np.r_[starts[1:], len(raw)]
        apart = _among(starts, begins) | _among(stops, begins)  # the first and the last of a text
        ids, sizes = [np.empty(0, np.uint32)], [np.zeros(1, np.int64)]
        at = 0
        while at < len(starts):
            if stops[at] - starts[at] > LONG:
                found = self._plain([raw[starts[at] : stops[at]].decode()])[0]
                ids.append(found)
                sizes.append(np.array([len(found)]))
                at += 1
                continue
            far = np.flatnonzero(stops[at:] - starts[at:] > LONG)
            upto = min(int(np.searchsorted(stops, starts[at] + WINDOW)), at + int(far[0]) if len(far) else len(starts))
            upto = max(upto, at + 1)
            if self.known.count > KNOWN - (upto - at):
                self._forget()
            numbers = self._numbers(raw, starts[at:upto], stops[at:upto], apart[at:upto])
            first = self.starts[numbers]
            size = self.starts[numbers + 1] - first
            behind = np.cumsum(size)
            ids.append(self.ids[np.repeat(first - behind + size, size) + np.arange(int(behind[-1]))])
            sizes.append(size)
            at = upto
        flat, cuts = np.concatenate(ids), np.cumsum(np.concatenate(sizes))
        bounds = cuts[np.searchsorted(starts, begins)]
        return [np.concatenate([flat[a:b], self.end]) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]


def _together(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """The texts in groups of about ``CALL_CHARS``, each with the place of its first; NULL is the empty text."""
    group: list[str] = []
    held = 0
    for at, text in enumerate(texts):
        group.append(text.as_py() or "")
        held += len(group[-1])
        if held >= CALL_CHARS:
            yield at + 1 - len(group), group
            group, held = [], 0
    if group:
        yield len(texts) - len(group), group


class BlockFile:
    """Reads one file; ``ids(a, b)`` touches no block but those that hold ids from ``a`` up to ``b``."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.source = source
        size = source.size()
        foot = struct.calcsize(_FOOT)
        blocks, docs, self.total, index, magic = struct.unpack(_FOOT, self._at(size - foot, foot))
        if magic != MAGIC:
            raise ValueError("not a file of token blocks, or not a whole one")
        tail = self._at(index, size - foot - index)
        self.starts = np.frombuffer(tail, "<u8", blocks + 1).astype(np.int64)
        at = 8 * (blocks + 1)
        self.doc_ids = np.frombuffer(tail, "<i8", docs, at)
        self.known = np.frombuffer(tail, np.uint8, docs, at + 8 * docs).astype(bool)
        self.lengths = np.frombuffer(tail, "<u8", docs, at + 9 * docs).astype(np.int64)
        self.ends = np.cumsum(self.lengths)

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        return self.source.read(length)

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.empty(0, np.uint32)
        first, last = a // BLOCK, (b - 1) // BLOCK
        data = self._at(int(self.starts[first]), int(self.starts[last + 1] - self.starts[first]))
        cuts = self.starts[first : last + 2] - self.starts[first]
        found = np.concatenate([unpack(data[cuts[k] : cuts[k + 1]]) for k in range(last - first + 1)])
        return found[a - first * BLOCK : b - first * BLOCK]


class BlockSource(DataSource):
    """``token_blocks``: writes rows in the order in which they come, a file for each partition, and reads documents.

    Rows to write are (doc_id, packed_ids: ids as little-endian unsigned 32-bit
    integers), or (doc_id, text) with the option ``tokenizer``, the path of a
    tokenizer file that executors can read, and ``end``, the id that ends each
    document.  Other options: ``path``; writing also ``percentile``.
    """

    @classmethod
    def name(cls) -> str:
        return "token_blocks"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return BlockReader(schema.fieldNames(), dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return BlockWriter(dict(self.options))


@dataclass
class Written(WriterCommitMessage):
    partition: int
    name: str
    docs: int
    ids: int
    least: int | None
    most: int | None


class BlockWriter(DataSourceArrowWriter):
    """A file for each partition.  Files count once the list of a whole job is written, so lost or repeated tasks leave
    nothing that is read; a folder takes one job, whose partitions give the order."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.job = options["path"], uuid.uuid4().hex
        self.percentile = float(options.get("percentile", PERCENTILE))
        self.tokenizer, self.end = options.get("tokenizer"), int(options.get("end", 0))

    def _rows(self, iterator: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
        """doc_ids and ids of some documents at a time."""
        coder = Coder(self.tokenizer, self.end) if self.tokenizer else None
        for batch in iterator:
            doc_ids = batch.column(batch.schema.get_field_index("doc_id"))
            if coder:
                for at, texts in _together(batch.column(batch.schema.get_field_index("text"))):
                    yield doc_ids.slice(at, len(texts)), coder.encoded(texts)
            else:
                packed = batch.column(batch.schema.get_field_index("packed_ids"))
                yield doc_ids, [np.frombuffer(p.as_buffer(), "<u4") for p in packed]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"{part:08d}-{uuid.uuid4().hex}.ids"
        doc_ids: list[np.ndarray] = []
        known: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        starts, position = [len(MAGIC)], len(MAGIC)
        waiting = np.empty(0, np.uint32)
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(MAGIC)

            def put(ids: np.ndarray) -> None:
                nonlocal position
                for block in pack(ids, self.percentile):
                    out.write(block)
                    position += len(block)
                    starts.append(position)

            for ids, rows in self._rows(iterator):
                known.append(np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), np.uint8))
                doc_ids.append(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                lengths.append(np.array([len(r) for r in rows], "<u8"))
                waiting = np.concatenate([waiting, *rows])
                while len(waiting) >= BLOCK:
                    blocks = min(len(waiting) // BLOCK, TOGETHER)
                    put(waiting[: blocks * BLOCK].reshape(blocks, BLOCK))
                    waiting = waiting[blocks * BLOCK :]
            if len(waiting):
                put(waiting[None, :])
            docs = [np.concatenate([np.empty(0, kind), *parts]) for kind, parts in (("<i8", doc_ids), (np.uint8, known), ("<u8", lengths))]
            total = int(docs[2].sum())
            out.write(np.array(starts, "<u8").tobytes())
            for column in docs:
                out.write(column.tobytes())
            out.write(struct.pack(_FOOT, len(starts) - 1, len(docs[0]), total, position, MAGIC))
        named = docs[0][docs[1] > 0]
        span = (int(named.min()), int(named.max())) if len(named) else (None, None)
        return Written(part, name, len(docs[0]), total, *span)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        if store.get_file_info(f"{root}/_files.json").type != fs.FileType.NotFound:
            raise ValueError(f"{self.path} holds token blocks already")
        files = [asdict(m) for m in sorted((m for m in messages if m and m.docs), key=lambda m: m.partition)]
        with store.open_output_stream(f"{root}/_files-{self.job}", compression=None) as out:
            out.write(json.dumps(files).encode())
        store.move(f"{root}/_files-{self.job}", f"{root}/_files.json")

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        for m in messages:
            if m:
                store.delete_file(f"{root}/{m.name}")


@dataclass
class Share(InputPartition):
    name: str
    before: int


class BlockReader(DataSourceReader):
    """A task for each file.  With doc_id = or IN given, files and blocks without these documents are not read; columns
    that the schema leaves out are not made, and without ids no block is."""

    def __init__(self, columns: list[str], options: dict[str, str]) -> None:
        self.columns, self.path = columns, options["path"]
        self.wanted: set[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("doc_id",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self) -> Sequence[Share]:
        store, root = _store(self.path)
        before, shares = 0, []
        for file in json.loads(store.open_input_stream(f"{root}/_files.json").read()):
            hit = self.wanted is None or (
                file["least"] is not None and any(v is not None and file["least"] <= v <= file["most"] for v in self.wanted)
            )
            if hit:
                shares.append(Share(file["name"], before))
            before += file["ids"]
        return shares or [Share("", 0)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        store, root = _store(self.path)
        with store.open_input_file(f"{root}/{partition.name}") as source:
            file = BlockFile(source)
            docs = np.arange(len(file.doc_ids))
            if self.wanted is not None:
                docs = docs[file.known & np.isin(file.doc_ids, list(self.wanted - {None}))]
            for run in _runs(docs, file):
                yield self._batch(file, run, partition)

    def _batch(self, file: BlockFile, docs: np.ndarray, share: Share) -> pa.RecordBatch:
        """``docs``: documents that follow one another."""
        starts = file.ends[docs] - file.lengths[docs]
        made = {
            "file": lambda: pa.array([share.name] * len(docs), pa.string()),
            "doc_id": lambda: pa.array(file.doc_ids[docs], pa.int64(), mask=~file.known[docs]),
            "start": lambda: pa.array(starts + share.before),
            "n_tokens": lambda: pa.array(file.lengths[docs]),
        }
        if {"ids", "packed_ids"} & set(self.columns):
            ids = file.ids(int(starts[0]), int(file.ends[docs[-1]]))
            offsets = np.r_[starts, file.ends[docs[-1]]] - starts[0]
            made["ids"] = lambda: pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
            made["packed_ids"] = lambda: pa.Array.from_buffers(
                pa.binary(), len(docs), [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]
            )
        return pa.RecordBatch.from_arrays([made[c]() for c in self.columns], self.columns)


def _runs(docs: np.ndarray, file: BlockFile, most: int = 1 << 20) -> Iterator[np.ndarray]:
    """Documents that follow one another, cut where a run holds ``most`` ids or more."""
    if not len(docs):
        return
    held = np.cumsum(file.lengths[docs]) // most
    cuts = np.flatnonzero((docs[1:] != docs[:-1] + 1) | (held[1:] != held[:-1])) + 1
    yield from np.split(docs, cuts)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let Spark hand filters to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BlockSource)


def tokenize(docs: DataFrame, tokenizer: str, end: int = 0) -> DataFrame:
    """doc_id, packed_ids of each row of ``docs`` (doc_id, text): the ids of the whole text and ``end``, for use without files.

    ``tokenizer`` is the path of a tokenizer file that executors can read.  NULL
    is the empty text: ``end`` alone.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(tokenizer, end)
        for batch in batches:
            for at, texts in _together(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array([ids.astype("<u4").tobytes() for ids in coder.encoded(texts)], pa.binary())], ["doc_id", "packed_ids"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, packed_ids binary")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of ``docs`` (doc_id BIGINT, text) to a new folder of block files, in ascending doc_id order.

    Texts are dealt out by ranges of doc_id, about ``file_bytes`` of them to a
    file, and become ids where they are written.  A NULL doc_id comes first;
    rows with one doc_id stand in the order of their texts.  An empty table
    gives a folder without files.
    """
    register(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spread = rows.repartitionByRange(int(size) // file_bytes + 1, "doc_id").sortWithinPartitions("doc_id", "text")
    spread.write.format("token_blocks").mode("append").options(tokenizer=tokenizer, end=end).save(path)


def read_tokens(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """The documents of a folder of block files, in the columns of ``schema``."""
    register(spark)
    return spark.read.format("token_blocks").schema(schema).load(path)


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row of ``docs`` (doc_id, text), from the files they were written to.

    Repeated rows are documents of their own; long texts are encoded whole.
    Extra columns are not read; an empty table gives no rows.
    """
    path = scratch_path(docs.sparkSession, "token-blocks")
    write_tokens(docs, path, tokenizer)
    back = read_tokens(docs.sparkSession, path, "doc_id long, start long, n_tokens long, packed_ids binary")
    return back.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "start", "n_tokens", F.crc32("packed_ids").alias("ids_crc32")
    )
