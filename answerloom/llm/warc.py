"""WARC archives as a Spark data source, and archiving of web pages with it.

``register(spark)`` makes ``spark.read.format("warc")`` and
``df.write.format("warc")`` known.  Archives are gzipped record by record.  Each
member tells its length in the skip-lengths field of its gzip header, so a
reader parses a record's headers and leaps over the rest where the record or its
payload is not wanted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from answerloom.llm.common import land, scratch_path

SCHEMA = (
    "file string, offset long, record_id string, record_type string, target_uri string, date string, "
    "headers map<string,string>, http map<string,string>, payload binary"
)
WRITTEN = "record_id string, record_type string, target_uri string, date string, headers map<string,string>, payload binary, payload_length long"
#: Where typed columns stand among a record's headers.
NAMED = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date"}
_STORED = {
    "file": pa.string(), "offset": pa.int64(), "record_id": pa.string(), "record_type": pa.string(), "target_uri": pa.string(),
    "date": pa.string(), "headers": pa.map_(pa.string(), pa.string()), "http": pa.map_(pa.string(), pa.string()), "payload": pa.binary(),
}
_HEAD = 4096


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[a-z0-9+]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def _fields(block: bytes) -> dict[str, str]:
    """Header lines after the first one."""
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k.strip()}


def _line(value: str) -> str:
    """A header's value; what could end its line is escaped."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def member(record: bytes) -> bytes:
    """A gzip member with skip-lengths (its own length and that of the record)."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    length = 24 + len(body) + 8
    if max(length, len(record)) >> 32:
        return struct.pack("<BBBBIBB", 31, 139, 8, 0, 0, 0, 255) + body + tail
    extra = struct.pack("<2sHII", b"sl", 8, length, len(record))
    return struct.pack("<BBBBIBBH", 31, 139, 8, 4, 0, 0, 255, len(extra)) + extra + body + tail


def record_bytes(row: dict) -> bytes:
    """One record; NULL columns give no header, a NULL payload is empty."""
    payload = row["payload"] or b""
    headers = [(NAMED[c], row[c]) for c in NAMED] + list(row["headers"] or [])
    length = len(payload) if row["payload_length"] is None else row["payload_length"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    lines = [f"{k}: {_line(str(v))}" for k, v in headers if v is not None]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    return b"".join([("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode(), http, payload, b"\r\n\r\n"])


class WarcSource(DataSource):
    """Options: ``path``; reading also ``partition_bytes`` (of archives for one task, 64 MB), ``types`` and
    ``where`` (record types, and a JSON object of header values, that a record must have); writing also
    ``file_bytes`` (an archive ends after it, 64 MB)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(schema.fieldNames(), dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(dict(self.options))


@dataclass
class Archives(InputPartition):
    files: Sequence[str]


class WarcReader(DataSourceReader):
    """Reads whole archives, several small ones to a task.

    Columns that the given schema leaves out are not made; without ``payload``
    and ``http`` no more than the headers is ever inflated.  Equality and IN on
    the columns of ``NAMED`` and on entries of ``headers`` given as options are
    decided on the headers, before the payload is touched.
    """

    def __init__(self, columns: list[str], options: dict[str, str]) -> None:
        self.columns, self.path = columns, options["path"]
        self.partition_bytes = int(options.get("partition_bytes", 64 << 20))
        self.wanted: list[tuple[str, frozenset[str]]] = []
        if types := options.get("types"):
            self.wanted.append(("WARC-Type", frozenset(types.split(","))))
        self.wanted += [(k, frozenset([v])) for k, v in json.loads(options.get("where", "{}")).items()]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = NAMED.get(f.attribute[0]) if isinstance(f, (EqualTo, In, IsNotNull)) and len(f.attribute) == 1 else None
            if name and isinstance(f, EqualTo):
                self.wanted.append((name, frozenset([f.value])))
            elif name and isinstance(f, In):
                self.wanted.append((name, frozenset(f.value)))
            else:
                yield f

    def partitions(self) -> Sequence[Archives]:
        store, root = _store(self.path)
        found = {i.path: i.size for i in store.get_file_info(fs.FileSelector(root, recursive=False)) if i.is_file}
        lists = [p for p in found if p.rsplit("/", 1)[-1].startswith("_committed-")]
        if lists:  # written by WarcWriter: only what whole jobs have written counts
            names = {n for p in lists for n in json.loads(store.open_input_stream(p).read())}
            found = {p: s for p, s in found.items() if p.rsplit("/", 1)[-1] in names}
        else:
            found = {p: s for p, s in found.items() if re.search(r"\.warc(\.gz)?$", p)}
        bins: list[list[str]] = [[]]
        room = self.partition_bytes
        for p in sorted(found):
            if bins[-1] and found[p] > room:
                bins.append([])
                room = self.partition_bytes
            bins[-1].append(p)
            room -= found[p]
        return [Archives(b) for b in bins]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        rows, held = [], 0
        for path in partition.files:
            with store.open_input_file(path) as archive:
                for row in self._records(archive, path):
                    rows.append(row)
                    held += len(row.get("payload") or b"") + 500
                    if held > 8 << 20:
                        yield self._batch(rows)
                        rows, held = [], 0
        yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(c) for r in rows], _STORED[c]) for c in self.columns], self.columns
        )

    def _records(self, archive: pa.NativeFile, path: str) -> Iterator[dict]:
        offset, end = 0, archive.size()
        while offset < end:
            archive.seek(offset)
            start = archive.read(_HEAD)
            zipped = start[:2] == b"\x1f\x8b"
            if zipped and start[3] == 4 and start[12:14] == b"sl":
                stored, _ = struct.unpack_from("<II", start, 16)
                take = _Gzip(archive, start)
            elif zipped:
                stored, take = None, _Gzip(archive, start)
            else:
                stored, take = None, _Plain(archive, start)
            head = take.until(b"\r\n\r\n")
            fields = _fields(head)
            length = int(fields.get("Content-Length", 0))
            good = all(fields.get(k) in values for k, values in self.wanted)
            row = None
            if good:
                row = {c: fields.get(name) for c, name in NAMED.items()}
                row |= {"file": path, "offset": offset, "headers": list(fields.items())}
                if "payload" in self.columns or "http" in self.columns:
                    block = take.exactly(length)
                    if fields.get("Content-Type", "").startswith("application/http"):
                        http, _, block = block.partition(b"\r\n\r\n")
                        row["http"] = list(_fields(http).items())
                    row["payload"] = block
            offset += stored if stored is not None else take.skip_to_end(length)
            if row is not None:
                yield row


class _Plain:
    """An uncompressed record: headers are read, the block is read or leapt over."""

    def __init__(self, archive: pa.NativeFile, start: bytes) -> None:
        self.archive, self.data, self.used = archive, start, 0

    def _more(self) -> bytes:
        more = self.archive.read(1 << 16)
        if not more:
            raise ValueError("an archive ends within a record")
        return more

    def until(self, mark: bytes) -> bytes:
        while (at := self.data.find(mark)) < 0:
            self.data += self._more()
        self.used = at + len(mark)
        return self.data[:at]

    def exactly(self, length: int) -> bytes:
        parts, have = [self.data[self.used :]], len(self.data) - self.used
        while have < length:
            parts.append(self._more())
            have += len(parts[-1])
        return b"".join(parts)[:length]

    def skip_to_end(self, length: int) -> int:
        return self.used + length + 4


class _Gzip(_Plain):
    """A record in a gzip member, inflated as far as it is asked for."""

    def __init__(self, archive: pa.NativeFile, start: bytes) -> None:
        self.unpack = zlib.decompressobj(31)
        self.fed = len(start)
        super().__init__(archive, self.unpack.decompress(start))

    def _more(self) -> bytes:
        while not self.unpack.eof:
            raw = self.archive.read(1 << 14)
            if not raw:
                break
            self.fed += len(raw)
            if data := self.unpack.decompress(raw):
                return data
        raise ValueError("an archive ends within a record")

    def skip_to_end(self, length: int) -> int:
        """Without skip-lengths the rest is inflated, though not kept, to find the end."""
        while not self.unpack.eof:
            raw = self.archive.read(1 << 16)
            if not raw:
                raise ValueError("an archive ends within a record")
            self.fed += len(raw)
            self.unpack.decompress(raw)
        return self.fed - len(self.unpack.unused_data)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """One or more archives from each task.  A job's files count once its list is written, so what lost or repeated
    tasks have left is never read."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.job = options["path"], uuid.uuid4().hex
        self.file_bytes = int(options.get("file_bytes", 64 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files: list[str] = []
        out, size = None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size > self.file_bytes:
                    if out is not None:
                        out.close()
                    files.append(f"{self.job}-{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                data = member(record_bytes(row))
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_committed-{self.job}", compression=None) as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        for m in messages:
            for f in m.files if m else ():
                store.delete_file(f"{root}/{f}")


def base32_sha1(payload: Column) -> Column:
    @F.arrow_udf("string")
    def run(payloads: pa.Array) -> pa.Array:
        return pa.array([base64.b32encode(hashlib.sha1(p.as_buffer()).digest()).decode() for p in payloads], pa.string())

    return run(payload)


def page_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Records for ``pages`` (page_id, url, html), in the columns of ``WRITTEN``.

    Of pages with equal payloads of at least ``least_bytes`` bytes, the one with
    the largest page_id is a response and the others are revisits that refer to
    it; rows that repeat that page_id are responses too, since a record cannot
    revisit itself.  A NULL page_id is never the largest; pages without any id
    are all responses.  NULL html is an empty payload, a NULL url gives no
    target.  Only digests that occur twice or more are joined back.
    """
    rows = pages.select(
        "page_id", "url", F.coalesce(F.encode("html", "utf-8"), F.lit(b"")).alias("payload")
    ).withColumn("_sha1", F.sha1("payload"))
    shared = land(
        rows.filter(F.octet_length("payload") >= least_bytes).groupBy("_sha1")
        .agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n"),
        "warc-shared",
    )
    own = F.col("page_id").cast("string")
    joined = rows.join(shared, "_sha1", "left").withColumn(
        "_revisit", F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    )

    def record_id(page: Column) -> Column:
        name = F.md5(F.concat_ws("\x00", F.coalesce(page, F.lit("")), F.col("_sha1")))
        return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))

    first = F.when(F.col("_revisit"), F.col("_first").cast("string"))
    return joined.select(
        record_id(own).alias("record_id"),
        F.when(F.col("_revisit"), "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.map_filter(
            F.create_map(
                F.lit("WARC-Payload-Digest"), F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))),
                F.lit("WARC-Refers-To"), F.when(F.col("_revisit"), record_id(first)),
                F.lit("WARC-Profile"), F.when(F.col("_revisit"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                F.lit("Payload-Length"), F.octet_length("payload").cast("string"),
                F.lit("Page-Id"), own,
                F.lit("Refers-To-Page-Id"), first,
            ),
            lambda _, v: v.isNotNull(),
        ).alias("headers"),
        F.when(~F.col("_revisit"), F.col("payload")).alias("payload"),
        F.octet_length("payload").cast("long").alias("payload_length"),
    )


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let Spark hand filters to Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive_pages(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    register(pages.sparkSession)
    page_records(pages, least_bytes).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, schema: str = SCHEMA, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def digest(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) below the shared folder, read it back and tell of each record what came back.

    Two reads with the record type as their filter: of responses the payload is
    inflated and measured again; of revisits nothing but the headers is.  NULL
    html is an empty payload like an empty text, long payloads are whole.  Of
    pages with one payload that with the largest page_id is the response, and
    rows that repeat that page_id are responses too.  Other columns are not
    read; an empty table gives no rows.
    """
    path = scratch_path(pages.sparkSession, "warc")
    archive_pages(pages, path)
    id_type = pages.schema["page_id"].dataType
    page_id = F.col("headers")["Page-Id"].cast(id_type).alias("page_id")

    def read(columns: str, kind: str) -> DataFrame:
        schema = f"record_type string, headers map<string,string>{columns}"
        return read_archive(pages.sparkSession, path, schema, partition_bytes=str(16 << 20)).filter(F.col("record_type") == kind)

    responses = read(", payload binary", "response").select(
        page_id,
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        "record_type",
        F.lit(None).cast(id_type).alias("refers_to"),
    )
    revisits = read("", "revisit").select(
        page_id,
        F.col("headers")["Payload-Length"].cast("long").alias("payload_bytes"),
        F.substring_index(F.col("headers")["WARC-Payload-Digest"], ":", -1).alias("payload_digest"),
        "record_type",
        F.col("headers")["Refers-To-Page-Id"].cast(id_type).alias("refers_to"),
    )
    return responses.unionAll(revisits)
