import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from answerloom.llm import warc
from answerloom.llm.common import scratch_path

SCHEMA = "page_id long, url string, html string, payload binary, record_type string, file string"
PAGES = [
    (1, "http://a/1", "<p>same</p>", None, "x", "y"),
    (2, "http://a/2", "<p>same</p>", None, "x", "y"),
    (3, "http://a/3", "<p>même\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n\r\n</p>", None, "x", "y"),
    (4, None, None, None, None, None),
    (5, "http://a/5\r\nWARC-Type: evil", "", None, "x", "y"),
    (None, "http://a/6", "<p>same</p>", None, "x", "y"),
    (7, "http://a/7", "x" * 3_000_000, None, "x", "y"),
    (8, "http://a/8", "twice", None, "x", "y"),
    (8, "http://a/8", "twice", None, "x", "y"),
]


def pages(spark):
    return spark.createDataFrame(PAGES, SCHEMA).repartition(3)


def want(pages, least=0):
    largest = {}
    for page_id, _, html, *_ in pages:
        if page_id is not None:
            largest[html or ""] = max(page_id, largest.get(html or "", page_id))
    out = []
    for page_id, _, html, *_ in pages:
        data = (html or "").encode()
        first = largest.get(html or "")
        revisit = first is not None and page_id != first and len(data) >= least
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    assert sorted(map(tuple, warc.digest(pages(spark)).collect()), key=str) == want(PAGES)


def test_payloads_headers_and_least_size(spark):
    path = scratch_path(spark, "warc-test")
    warc.archive_pages(pages(spark), path, least_bytes=6)
    rows = warc.read_archive(spark, path).collect()
    assert sorted(((r.headers.get("Page-Id"), r.record_type) for r in rows), key=str) == sorted(
        ((None if p is None else str(p), kind) for p, _, _, kind, _ in want(PAGES, 6)), key=str
    )
    by_page = {r.headers.get("Page-Id"): r for r in rows}
    for page_id, url, html, *_ in PAGES:
        r = by_page[None if page_id is None else str(page_id)]
        if r.record_type == "response":
            assert bytes(r.payload) == (html or "").encode()
        assert int(r.http["Content-Length"]) == len((html or "").encode())
    assert by_page["5"].target_uri == "http://a/5%0D%0AWARC-Type: evil" and by_page["4"].target_uri is None
    assert by_page["1"].headers["WARC-Refers-To"] == by_page["2"].record_id
    assert len({(r.file, r.offset) for r in rows}) == len(rows)


def test_pushed_filters_and_left_out_columns(spark):
    path = scratch_path(spark, "warc-test")
    warc.archive_pages(pages(spark), path)
    df = warc.read_archive(spark, path, "record_id string, record_type string, target_uri string")
    found = df.filter((F.col("record_type") == "revisit") & F.col("target_uri").isin("http://a/1", "http://a/9"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert [r.target_uri for r in found.collect()] == ["http://a/1"]
    assert "Filter (" not in plan or "record_type" not in plan.split("Filter (")[1].split("\n")[0]
    by_header = warc.read_archive(spark, path, where='{"Page-Id": "3"}')
    assert [r.record_type for r in by_header.collect()] == ["response"]
    assert warc.read_archive(spark, path, types="revisit,other").count() == 3


def test_payload_is_not_inflated_without_need(tmp_path, monkeypatch):
    """With skip-lengths the rest of a member is never read, so it may even be broken."""
    row = {"record_id": "<urn:a>", "record_type": "response", "target_uri": None, "date": None, "headers": [], "payload_length": None}
    import random
    noise = random.Random(1).randbytes(200_000)
    data = bytearray(warc.member(warc.record_bytes(row | {"payload": noise})))
    data[150_000:150_100] = b"\0" * 100
    data += warc.member(warc.record_bytes(row | {"payload": b"ok", "record_type": "resource"}))
    (tmp_path / "a.warc.gz").write_bytes(data)
    reader = warc.WarcReader(["record_type", "offset"], {"path": str(tmp_path)})
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["record_type"] for r in rows] == ["response", "resource"]


def test_foreign_archives(spark, tmp_path):
    """Plain files and gzip members without skip-lengths."""
    row = {"record_id": "<urn:a>", "record_type": "response", "target_uri": "http://x", "date": None, "headers": [], "payload_length": None}
    records = [warc.record_bytes(row | {"payload": b"p" * n}) for n in (0, 10, 200_000)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "notes.txt").write_text("not an archive")
    got = warc.read_archive(spark, str(tmp_path), partition_bytes="1").collect()
    assert sorted(len(r.payload) for r in got) == [0, 0, 10, 10, 200_000, 200_000]
    assert warc.read_archive(spark, str(tmp_path), "record_type string").count() == 6


def test_no_pages(spark):
    assert warc.digest(spark.createDataFrame([], SCHEMA)).collect() == []
