"""Blocks and files of token ids: round trips, and the digest against the tokenizer itself."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from answerloom.llm import token_blocks
from answerloom.llm.common import scratch_path
from tests.llm import cases

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def tokens(text):
    from tokenizers import Tokenizer

    tokens.coder = getattr(tokens, "coder", None) or Tokenizer.from_file(PATH)
    return [*tokens.coder.encode(text or "", add_special_tokens=False).ids, 0]


def brute(rows):
    """rows: (doc_id, text)."""
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = tokens(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return Counter(out)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(0, 60), st.just(7)), min_size=1, max_size=200),
    st.sampled_from([0.0, 0.5, 0.9, 1.0]),
)
def test_block_round_trip(ids, percentile):
    matrix = np.array([ids, ids[::-1], [ids[0]] * len(ids)], np.uint32)
    for row, block in zip(matrix, token_blocks.pack(matrix, percentile)):
        assert token_blocks.unpack(block).tolist() == row.tolist()


def test_few_large_ids_are_exceptions():
    ids = np.full((1, 1024), 1000, np.uint32) + np.arange(1024, dtype=np.uint32) % 16
    ids[0, ::50] = 50_000
    size, exceptions, least, width = np.frombuffer(token_blocks.pack(ids)[0], "<u4", 4).tolist()
    assert (size, exceptions, least, width) == (1024, 21, 1000, 4)
    assert len(token_blocks.pack(ids)[0]) == 16 + 1024 * 4 // 8 + 21 * 8


def test_odd_documents(spark):
    docs = cases.documents(spark)
    got = token_blocks.digest(docs, PATH)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert Counter(map(tuple, got.collect())) == brute([(r.doc_id, r.text) for r in docs.collect()])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\r\x1c\x85\xa0\u3000abZ1٣.,'’<|>é東\u0301", max_size=40), max_size=6))
def test_cut_texts_have_the_ids_of_whole_ones(texts):
    texts = [*texts, "it's  a <|endoftext|> b\n\n c", "don't "]
    coder = test_cut_texts_have_the_ids_of_whole_ones.coder
    assert coder.spaced
    for text, ids in zip(texts, coder.encoded(texts)):
        assert ids.tolist() == tokens(text)


test_cut_texts_have_the_ids_of_whole_ones.coder = token_blocks.Coder(PATH, 0)


@pytest.mark.parametrize("window, long, known", [(1 << 20, 512, 1 << 20), (64, 512, 1 << 20), (50, 9, 1 << 20), (40, 30, 64)])
def test_windows_long_stretches_and_forgetting_do_not_matter(monkeypatch, window, long, known):
    for name, value in (("WINDOW", window), ("LONG", long), ("KNOWN", known)):
        monkeypatch.setattr(token_blocks, name, value)
    texts = [r[1] or "" for r in cases.rows()] + ["", "x" * 3000, " lead", "trail ", "  ", "é à\u3000b c", "a" * 600 + " b " + "c" * 700]
    coder = token_blocks.Coder(PATH, 0)
    for _ in range(2):
        assert [i.tolist() for i in coder.encoded(texts)] == [tokens(t) for t in texts]


def test_other_tokenizers_get_whole_texts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert not token_blocks.Coder(path, 0).spaced
    from tokenizers import Tokenizer

    text = cases.prose(50, 1)
    row = token_blocks.tokenize(spark.createDataFrame([(1, text)], "doc_id int, text string"), path, end=9).first()
    assert np.frombuffer(row.packed_ids, "<u4").tolist() == [*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 9]


def test_empty(spark):
    assert token_blocks.digest(cases.empty(spark), PATH).collect() == []


@pytest.fixture(scope="module")
def folder(spark):
    pick = random.Random(9)
    rows = [(pick.randrange(10**9) - 10**8, cases.prose(pick.randrange(700), k)) for k in range(400)]
    path = scratch_path(spark, "test-blocks")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    token_blocks.write_tokens(docs, path, PATH, file_bytes=100_000)
    return path, rows


def test_many_files(spark, folder):
    path, rows = folder
    back = token_blocks.read_tokens(spark, path).withColumn("crc", F.crc32("packed_ids")).collect()
    assert len({r.file for r in back}) > 5
    assert Counter((r.doc_id, r.start, r.n_tokens, r.crc) for r in back) == brute(rows)
    texts = dict(rows)
    for r in back[:50]:
        assert r.ids == tokens(texts[r.doc_id]) and len(r.packed_ids) == 4 * r.n_tokens


def test_few_documents_are_read_by_themselves(spark, folder, monkeypatch):
    path, rows = folder
    wanted = [rows[3][0], rows[200][0], -5]
    back = token_blocks.read_tokens(spark, path)
    texts = dict(rows)
    found = {r.doc_id: r.ids for r in back.filter(F.col("doc_id").isin(wanted)).collect()}
    assert found == {d: tokens(texts[d]) for d in wanted[:2]}
    assert [r.doc_id for r in back.filter(F.col("doc_id") == wanted[0]).select("doc_id", "start").collect()] == wanted[:1]
    reader = token_blocks.BlockReader(["doc_id", "ids"], {"path": path})
    list(reader.pushFilters([token_blocks.EqualTo(("doc_id",), wanted[0])]))
    shares = reader.partitions()
    assert len(shares) == 1
    blocks = []
    plain = token_blocks.unpack
    monkeypatch.setattr(token_blocks, "unpack", lambda b: blocks.append(1) or plain(b))
    assert [b.num_rows for b in reader.read(shares[0])] == [1]
    assert 1 <= len(blocks) <= 1 + -(-len(tokens(texts[wanted[0]])) // token_blocks.BLOCK)


def test_a_folder_takes_one_job(spark, folder):
    path, rows = folder
    with pytest.raises(Exception, match="holds token blocks already"):
        token_blocks.write_tokens(spark.createDataFrame(rows[:2], "doc_id long, text string"), path, PATH)


def test_uncommitted_files_do_not_count(spark, folder):
    path, rows = folder
    from pyarrow import fs

    store, root = token_blocks._store(path)
    with store.open_output_stream(f"{root}/00000000-left.ids") as out:
        out.write(b"half a file")
    assert token_blocks.read_tokens(spark, path).count() == len(rows) and fs
