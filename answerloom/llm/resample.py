"""Importance resampling towards a target distribution of hashed n-grams.

A text is brought to its separator-normalised form (words joined by one space)
and scanned once: its running CRC-32 is kept at the start and at the end of each
word.  The CRC of any n-gram follows from two of these prefixes, since
``crc(prefix + gram) = shift(crc(prefix), len(gram)) xor crc(gram)`` and the
shift, a multiplication by a power of x over GF(2), is linear: tables of its
values for each byte of a CRC give it for whole arrays at a time.

Counts per bucket over the corpus and over the target give each bucket a gain,
the gains of a document's n-grams its weight, and the largest weights with
Gumbel noise are a sample without replacement in proportion to the weights'
exponentials.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.common import land, ranked, spare_name

BUCKETS = 10_000
LONGEST = 3
#: A piece of text scanned at once, in bytes, whatever the length of the documents.
PIECE = 1 << 20
#: Shifts by fewer bytes than this have a table each; longer ones are put together from powers of two.
SHORT = 256

#: ASCII upper case to lower case, every other ASCII character that is no digit or letter to a space.
_NORMAL = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)


def _byte_step() -> np.ndarray:
    """What a zero byte makes of each low byte of a CRC-32 state (reflected polynomial)."""
    states = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        states = (states >> 1) ^ np.where(states & 1, np.uint32(0xEDB88320), np.uint32(0))
    return states


STEP = _byte_step()


class Shifts:
    """``crc`` times x to the power of ``8 * length`` modulo the CRC polynomial."""

    def __init__(self) -> None:
        ones = np.arange(256, dtype=np.uint32)
        at = np.stack([ones << (8 * k) for k in range(4)])  # shift by nothing: each byte stays in its place
        tables = [at]
        for _ in range(1, SHORT):
            at = (at >> 8) ^ STEP[at & 0xFF]
            tables.append(at)
        self.short = np.concatenate([t.ravel() for t in tables])  # [length][byte of the CRC][its value]
        at = (at >> 8) ^ STEP[at & 0xFF]
        self.powers = [at]  # shifts by SHORT, 2 * SHORT, 4 * SHORT, ...

    def _power(self, k: int) -> np.ndarray:
        while len(self.powers) <= k:
            last = self.powers[-1]
            self.powers.append(self._apply(last, last))
        return self.powers[k]

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & 0xFF] ^ table[1][(crc >> 8) & 0xFF] ^ table[2][(crc >> 16) & 0xFF] ^ table[3][crc >> 24]

    def __call__(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        base = (length & (SHORT - 1)) * 1024
        out = self.short[base + (crc & 0xFF)]
        out ^= self.short[base + 256 + ((crc >> 8) & 0xFF)]
        out ^= self.short[base + 512 + ((crc >> 16) & 0xFF)]
        out ^= self.short[base + 768 + (crc >> 24)]
        high = length // SHORT
        k = 0
        while high.any():
            odd = np.flatnonzero(high & 1)
            if len(odd):
                out[odd] = self._apply(self._power(k), out[odd])
            high, k = high >> 1, k + 1
        return out


class Scan:
    """Running CRCs over the words of one or more texts, and the buckets of their n-grams.

    ``owner`` tells the text of each word.  Words up to ``lead`` belong to the
    piece before and only begin n-grams.
    """

    def __init__(self, words: list[bytes], owner: np.ndarray, lead: int = 0) -> None:
        self.owner, self.lead = owner, lead
        size = np.fromiter(map(len, words), np.int64, len(words))
        self.end = np.cumsum(size + 1)  # each word follows one space
        self.start = self.end - size
        running = accumulate(words, lambda crc, word: crc32(word, crc32(b" ", crc)), initial=0)
        ends = np.fromiter(running, np.uint32, len(words) + 1)
        self.after = ends[1:]
        before = ends[:-1] ^ np.uint32(0xFFFFFFFF)
        self.before = ((before >> 8) ^ STEP[(before ^ 0x20) & 0xFF]) ^ np.uint32(0xFFFFFFFF)  # behind the space

    def grams(self, n: int, shifts: Shifts) -> tuple[np.ndarray, np.ndarray]:
        """CRC-32 of every run of ``n`` words of one text, and its last word."""
        last = np.arange(max(n - 1, self.lead), len(self.owner))
        last = last[self.owner[last] == self.owner[last - n + 1]]
        first = last - n + 1
        return self.after[last] ^ shifts(self.before[first], self.end[last] - self.start[first]), last


def _pieces(text: bytes) -> Iterator[bytes]:
    """Normalised text in pieces of about ``PIECE`` bytes, cut at spaces."""
    if len(text) <= PIECE:
        yield text
        return
    start = 0
    while start < len(text):
        stop = text.find(b" ", start + PIECE)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop]
        start = stop


def scans(texts: Iterable[bytes | None], longest: int = LONGEST) -> Iterator[Scan]:
    """Scans over the texts, several short ones together, a long one in pieces; ``owner`` counts the texts."""
    words: list[bytes] = []
    owner: list[np.ndarray] = []
    held = 0
    for at, text in enumerate(texts):
        kept: list[bytes] = []
        lead = 0
        for piece in _pieces((text or b"").translate(_NORMAL)):
            own = piece.split()
            if held + len(piece) > PIECE and words:
                yield Scan(words, np.concatenate(owner), lead)
                words, owner, held, lead = list(kept), [np.full(len(kept), at)], 0, len(kept)
            words += own
            owner.append(np.full(len(own), at))
            held += len(piece) + 1
            kept = (kept + own)[-(longest - 1):] if longest > 1 else []
            if len(piece) >= PIECE and words:  # the text may go on
                yield Scan(words, np.concatenate(owner), lead)
                words, owner, held, lead = list(kept), [np.full(len(kept), at)], 0, len(kept)
        if lead:  # the next text must not begin behind a lead
            yield Scan(words, np.concatenate(owner), lead)
            words, owner, held = [], [], 0
    if words:
        yield Scan(words, np.concatenate(owner))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """bucket, n: how many n-grams of 1 to ``longest`` words of all ``texts`` (text) fall into each bucket that has any.

    A task adds up its own texts first and gives at most ``buckets`` rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, found = Shifts(), np.zeros(buckets, np.int64)
        for batch in batches:
            for scan in scans((t.as_py() for t in batch.column("text")), longest):
                for n in range(1, longest + 1):
                    found += np.bincount(scan.grams(n, shifts)[0] % buckets, minlength=buckets)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["bucket", "n"])

    counts = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from its counts in the corpus and in the target, each smoothed by one.

    One number for each bucket, so its size is set by the parameter alone.
    """
    both = raw.select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionAll(
        target.select("bucket", F.lit(0), F.col("n"))
    )
    rows = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    s, t = np.zeros(buckets), np.zeros(buckets)
    for r in rows:
        s[r.bucket], t[r.bucket] = r.s, r.t
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_words, n_features, weight (the sum of the gains of all n-grams) for each row of ``docs`` (doc_id, text)."""
    buckets = len(gain)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = Shifts()
        for batch in batches:
            rows = batch.num_rows
            n_words, n_features, weight = (np.zeros(rows, np.int64) for _ in range(3))
            for scan in scans((t.as_py() for t in batch.column("text")), longest):
                n_words += np.bincount(scan.owner[scan.lead :], minlength=rows)
                for n in range(1, longest + 1):
                    crcs, last = scan.grams(n, shifts)
                    if not len(last):
                        continue
                    owner = scan.owner[last]  # ascending: texts follow one another
                    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                    weight[owner[first]] += np.add.reduceat(gain[crcs % buckets], first)
                    n_features[owner[first]] += np.diff(np.r_[first, len(owner)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (n_words, n_features, weight))],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Seeded Gumbel noise in thousandths, from the hash of the id; a NULL id counts as the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = 5,
    least_words: int = 20,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = 42,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank for each row of ``docs`` (doc_id, text); ``target`` (text) is the distribution aimed at.

    Of the documents with ``least_words`` words or more, ``percent`` of a hundred
    (rounded down) with the highest scores are drawn and ranked from 1; ties go
    to the smaller doc_id, a NULL one first.  NULL, empty and blank texts have no
    feature and the weight 0.  Repeated rows count each and may each be drawn.
    Long texts are scanned in pieces.  Extra columns are not read; an empty table
    gives no rows, an empty target leaves the corpus alone to decide.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest), buckets)
    scored = land(
        weights(docs, gain, longest).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "resample-scores"
    )
    enough = F.col("n_words") >= least_words
    drawn = scored.filter(enough).count() * percent // 100
    order = [F.desc("_enough"), F.desc("score"), F.asc("doc_id"), F.asc("weight"), F.asc("n_features")]
    placed = ranked(scored.withColumn("_enough", enough), [], order, "_at", "_all", "resample-ranks")
    return placed.select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("_enough") & (F.col("_at") < drawn), F.col("_at") + 1).cast("long").alias("rank"),
    )


def keep_drawn(docs: DataFrame, target: DataFrame, **settings: int) -> DataFrame:
    """The rows of ``docs`` whose doc_id is drawn, as they are; rows that share a drawn id all stay."""
    mark = spare_name(docs.columns, "drawn_id")
    drawn = resample(docs, target, **settings).filter("rank is not null").select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(drawn, F.col("doc_id").eqNullSafe(F.col(mark)), "left_semi")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``resample`` with its defaults, towards the texts of ``benchmark`` (text)."""
    return resample(docs, benchmark)
