"""Secret scans: fixed forms, and a battery of randomness tests for everything else.

Every run of 20 or more characters of a token alphabet is tested; where fixed
forms lie in it, what they leave of it, if that has 20 or more.  Its encoding
is inferred from the kinds of characters it holds.  A chi-squared test of
uniformity over that alphabet, a runs test and a lag-1 serial correlation test
say whether the run looks random; how improbable its evenness would be for
running text of its length is its p-value.  Those go through the
Benjamini-Hochberg procedure over the whole corpus, weighted by length, because
a short run carries little evidence.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.common import land

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind, pattern, group whose length counts, least length.  Runs of one class are maximal, so there the
#: length can stand in the pattern; a short assignment still uses up its text.
KINDS = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
ADDED = "random"
LEAST = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Chance that two letters of running text agree (index of coincidence).
LANGUAGE_MATCH = 0.066
#: A run is taken for random while the combined battery does not reject that at this level.
BATTERY_LEVEL = 0.001
FALSE_DISCOVERY_RATE = 0.01
#: Bins of -log10(p), 100 to a decade, for the procedure's ranks.
BINS = 3000

SPAN = "array<struct<start:int,end:int,rank:int,kind:string>>"


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sum(numbers: Column, chunk: int = 256) -> Column:
    """Sum of all earlier entries, for each entry; in chunks, so that arrays are not copied once per entry."""

    def inner(places: Column, start: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(start.alias("pos"), F.array().cast("array<int>").alias("out")),
            lambda a, i: F.struct(
                (a["pos"] + F.get(numbers, i)).alias("pos"), F.array_append(a["out"], a["pos"]).alias("out")
            ),
        )

    def outer(acc: Column, c: Column) -> Column:
        return _let(
            inner(F.sequence(c * chunk, F.least((c + 1) * chunk, F.size(numbers)) - 1), acc["pos"]),
            lambda r: F.struct(r["pos"].alias("pos"), F.array_append(acc["out"], r["out"]).alias("out")),
        )

    chunks = F.sequence(F.lit(0), ((F.size(numbers) - 1) / chunk).cast("int"))
    state = F.struct(F.lit(0).alias("pos"), F.array().cast("array<array<int>>").alias("out"))
    return F.when(F.size(numbers) == 0, F.array().cast("array<int>")).otherwise(
        F.aggregate(chunks, state, outer, lambda acc: F.flatten(acc["out"]))
    )


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, end, value of the group); code points, end exclusive.

    Texts without a match cost one search.  Else the pieces between matches and
    the matches themselves give the positions.
    """
    regex = F.lit(pattern)
    lengths = F.transform(F.regexp_extract_all(text, regex, F.lit(0)), F.char_length)
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)

    def build(l: Column) -> Column:  # noqa: E741
        def with_gaps(g: Column) -> Column:
            moves = F.zip_with(F.slice(g, F.lit(1), F.size(l)), l, lambda a, b: a + b)
            return F.transform(
                F.arrays_zip(
                    _let(moves, lambda m: running_sum(m)).alias("before"), g.alias("gap"), l.alias("len"),
                    F.regexp_extract_all(text, regex, F.lit(group)).alias("value"),
                ),
                lambda z: F.struct(
                    (z["before"] + z["gap"]).alias("start"), (z["before"] + z["gap"] + z["len"]).alias("end"), z["value"].alias("value")
                ),
            )

        return F.slice(_let(gaps, with_gaps), F.lit(1), F.size(l))

    return F.when(F.rlike(text, regex), _let(lengths, build)).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>")
    )


def base_spans(text: Column) -> Column:
    """Spans of the fixed forms in the order of ``KINDS``."""
    found = []
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        good = F.filter(matches(text, pattern, group), lambda m: F.char_length(m["value"]) >= least)
        found.append(
            F.transform(
                good,
                lambda m: F.struct(
                    m["start"].alias("start"), m["end"].alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind")
                ),
            ).cast(SPAN)
        )
    return F.concat(*found)


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal distribution, relative error below 1e-6 for z > 0 (continued fraction from 3 on)."""
    x = F.abs(z)
    # Abramowitz and Stegun 26.2.17.
    t = 1 / (1 + 0.2316419 * x)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    fraction = 1 / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 5 / (x + 6))))))
    tail = F.when(x > 3, density * fraction).otherwise(density * series)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def alphabet_size(token: Column) -> Column:
    """Size of the inferred encoding: hexadecimal, base32, or the kinds of characters that occur."""
    kinds = (
        26 * F.rlike(token, F.lit("[a-z]")).cast("int")
        + 26 * F.rlike(token, F.lit("[A-Z]")).cast("int")
        + 10 * F.rlike(token, F.lit("[0-9]")).cast("int")
        + 2 * F.rlike(token, F.lit("[+/_=-]")).cast("int")
    )
    return (
        F.when(F.rlike(token, F.lit("^(?:[0-9a-f]+|[0-9A-F]+)$")) & F.rlike(token, F.lit("[a-fA-F]")), 16)
        .when(F.rlike(token, F.lit("^[A-Z2-7]+=*$")) & F.rlike(token, F.lit("[2-7]")), 32)
        .when(F.rlike(token, F.lit("^[+/_=-]+$")), 5)
        .otherwise(kinds)
        .cast("double")
    )


def battery(token: Column) -> Column:
    """(size of the alphabet, length, chi2, z_runs, z_serial) of one run of characters; linear in its length."""
    n = F.char_length(token).cast("double")
    characters = F.filter(F.split(token, ""), lambda c: c != "")

    def with_characters(chars: Column) -> Column:
        squares = F.aggregate(
            F.array_distinct(chars),
            F.lit(0.0),
            lambda acc, c: acc + F.pow(n - F.char_length(F.replace(token, c, F.lit(""))), F.lit(2)),
        )
        codes = F.transform(chars, lambda c: F.ascii(c).cast("double"))
        mean = F.aggregate(codes, F.lit(0.0), lambda a, x: a + x) / n
        return _let(F.struct(squares.alias("squares"), codes.alias("codes"), mean.alias("mean")), with_moments)

    def with_moments(m: Column) -> Column:
        zero = F.lit(0.0)
        first = F.struct(
            zero.alias("above"), zero.alias("runs"), zero.alias("lagged"), zero.alias("var"), F.lit(None).cast("double").alias("last")
        )

        def step(a: Column, x: Column) -> Column:
            d = x - m["mean"]
            return F.struct(
                (a["above"] + (d > 0).cast("double")).alias("above"),
                (a["runs"] + F.when(a["last"].isNull() | ((a["last"] > 0) != (d > 0)), 1.0).otherwise(0.0)).alias("runs"),
                (a["lagged"] + F.coalesce(a["last"], zero) * d).alias("lagged"),
                (a["var"] + d * d).alias("var"),
                d.alias("last"),
            )

        return _let(F.aggregate(m["codes"], first, step), lambda s: result(m, s))

    def result(m: Column, s: Column) -> Column:
        size = alphabet_size(token)
        above, below = s["above"], n - s["above"]
        expected = 2 * above * below / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        return F.struct(
            size.alias("size"),
            n.alias("n"),
            (m["squares"] * size / n - n).alias("chi2"),
            F.when(variance > 0, (s["runs"] - expected) / F.sqrt(variance)).otherwise(99.0).alias("z_runs"),
            F.when(s["var"] > 0, (s["lagged"] / s["var"] + 1 / n) * F.sqrt(n)).otherwise(99.0).alias("z_serial"),
        )

    return _let(characters, with_characters)


def judged(b: Column) -> Column:
    """(n, p, random): the p-value against running text, and whether the battery lets the run pass for random."""
    freedom = b["size"] - 1
    # Wilson-Hilferty: the cube root of a chi-squared variable is nearly normal.
    root = F.cbrt(F.greatest(b["chi2"], F.lit(0.0)) / freedom)
    z_even = (root - (1 - 2 / (9 * freedom))) / F.sqrt(2 / (9 * freedom))
    rejects = F.least(upper_tail(z_even), 2 * upper_tail(F.abs(b["z_runs"])), 2 * upper_tail(F.abs(b["z_serial"])))
    excess = b["n"] * F.greatest(b["size"] * LANGUAGE_MATCH - 1, F.lit(0.3))
    z_text = (freedom + excess - b["chi2"]) / F.sqrt(2 * freedom + 4 * excess)
    return F.struct(
        b["n"].alias("n"),
        F.greatest(upper_tail(z_text), F.lit(1e-30)).alias("p"),
        (3 * rejects >= BATTERY_LEVEL).alias("random"),
    )


def left_over(run: Column, spans: Column) -> Column:
    """What ``spans`` leave of a run: pieces of ``LEAST`` or more characters, as (start, end, value)."""
    first = F.struct(run["start"].alias("at"), F.slice(F.array(run), 1, 0).alias("out"))

    def with_piece(a: Column, end: Column) -> Column:
        piece = F.struct(
            a["at"].alias("start"), end.alias("end"), F.substring(run["value"], a["at"] - run["start"] + 1, end - a["at"]).alias("value")
        )
        return F.when(end - a["at"] >= LEAST, F.array_append(a["out"], piece)).otherwise(a["out"])

    def step(a: Column, b: Column) -> Column:
        return F.struct(F.greatest(a["at"], b["end"]).alias("at"), with_piece(a, b["start"]).alias("out"))

    touching = F.array_sort(F.filter(spans, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])))
    return _let(
        touching,
        lambda t: F.when(F.size(t) == 0, F.array(run)).otherwise(
            F.aggregate(t, first, step, lambda a: with_piece(a, run["end"]))
        ),
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` (spans of the fixed forms) and ``runs`` (tested runs outside them); row-local, landed once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", text.alias("_text")).select(
        "doc_id", base_spans(F.col("_text")).alias("base"), matches(F.col("_text"), CANDIDATE).alias("_runs")
    )
    outside = F.flatten(F.transform("_runs", lambda r: left_over(r, F.col("base"))))
    tested = F.transform(
        outside,
        lambda r: _let(
            _let(battery(r["value"]), judged),
            lambda j: F.struct(
                r["start"].alias("start"), r["end"].alias("end"), j["n"].alias("n"), j["p"].alias("p"), j["random"].alias("random")
            ),
        ),
    )
    return land(found.select("doc_id", "base", tested.alias("runs")), "secret-runs")


def discovery_threshold(scanned: DataFrame, rate: float = FALSE_DISCOVERY_RATE) -> tuple[float, float]:
    """(mean length, greatest weighted p-value that the Benjamini-Hochberg procedure accepts) over all tested runs.

    The ranks come from counts of at most ``BINS`` bins; a bin counts with its
    upper end, so the false discovery rate is kept.  (1, 0) without a run.
    """
    runs = scanned.select(F.explode("runs").alias("r")).select("r.n", "r.p", "r.random")
    total = runs.agg(F.count("*").alias("m"), F.avg("n").alias("mean")).first()
    if not total["m"]:
        return 1.0, 0.0
    weighted = F.least(F.lit(1.0), F.col("p") * total["mean"] / F.col("n"))
    bins = (
        runs.filter("random").groupBy(F.least(F.floor(-100 * F.log10(weighted)), F.lit(BINS)).alias("bin"))
        .agg(F.count("*").alias("k")).collect()
    )  # at most BINS + 1 rows
    below, threshold = 0, 0.0
    for row in sorted(bins, key=lambda r: -r["bin"]):
        below += row["k"]
        if 10 ** (-row["bin"] / 100) <= rate * below / total["m"]:
            threshold = 10 ** (-row["bin"] / 100)
    return float(total["mean"]), threshold


def secrets(docs: DataFrame, rate: float = FALSE_DISCOVERY_RATE) -> DataFrame:
    """doc_id, ``base`` and ``added`` spans (start, end, rank, kind) for each row of ``docs`` (doc_id, text).

    Positions are code points of the whole text, ends exclusive.  NULL and
    empty texts have no spans.  The verdict on a run depends on its characters
    and on the corpus, so repeated rows get the same.  Other columns are not
    read; an empty table gives no rows.
    """
    scanned = scan(docs)
    mean, threshold = discovery_threshold(scanned, rate)
    accepted = F.filter(
        F.col("runs"), lambda r: r["random"] & (F.least(F.lit(1.0), r["p"] * mean / r["n"]) <= threshold)
    )
    added = F.transform(
        accepted,
        lambda r: F.struct(
            r["start"].alias("start"), r["end"].alias("end"), F.lit(len(KINDS)).alias("rank"), F.lit(ADDED).alias("kind")
        ),
    )
    return scanned.select("doc_id", "base", added.cast(SPAN).alias("added"))


def _joined(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))
    texts = F.transform(
        ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(texts, ",")


def digest(docs: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secrets(docs).select(
        "doc_id",
        *(count(kind) for kind, *_ in KINDS),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"),
    )
