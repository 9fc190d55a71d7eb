"""Quality by weak supervision: rules vote or abstain, and a posterior decides.

Every rule votes good (1), bad (-1) or abstains (0).  Expectation-maximisation
over the counts of vote patterns estimates how often each rule is right when it
votes and how many documents are good; the posterior probability then replaces
"all rules must pass".  There are at most ``3 ** len(RULES)`` patterns, however
many documents vote.

A kind of junk shows in a few rules only, so rules abstain where they see nothing
instead of voting good, and each kind is seen by two rules or more, which bear
each other out.  Every rule begins with some votes of accuracy ``START``, so one that
hardly ever votes keeps about that, and with more votes the estimate tends to that
of plain expectation-maximisation.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.common import land, words

SYMBOLS = "#*$%&|<>"
RULES = (
    "symbols", "symbol_words", "upper_case", "exclamations", "bars", "sentence_ends", "repeats", "repeated_lines", "prose",
)
#: Where EM starts: accuracy of each rule, which it is smoothed towards as well, and share of good documents.
START = 0.9
START_GOOD = 0.7
#: Votes of accuracy ``START`` that each rule begins with, however many it casts.
PSEUDO_VOTES = 100.0
ROUNDS = 15
#: Estimates keep this far from certainty.
MARGIN = 0.01


def repeat_words(words: Column, window: int = 3) -> Column:
    """How many words lie in windows of ``window`` words that the array holds twice or more.

    Windows are compared by their XXH64.  Hashes are sorted with the position in
    their low bits, which sorts plain longs; a text in which the shortened
    hashes clash is done again with whole hashes beside the positions.
    """
    n = F.size(words)
    count = n - (window - 1)
    hashes = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(window)))
    )
    bits = 24
    low = (1 << bits) - 1

    def covered(starts: Column) -> Column:
        """Words under windows at these sorted starts."""
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("sum"), F.lit(-window).alias("last")),
            lambda acc, s: F.struct(
                (acc["sum"] + F.least(F.lit(window), s - acc["last"])).alias("sum"), s.alias("last")
            ),
            lambda acc: acc["sum"],
        )

    def same_pairs(keys: Column, equal) -> Column:
        """Positions in the sorted keys that equal a neighbour."""
        last = F.size(keys) - 1
        return F.filter(
            F.sequence(F.lit(0), last),
            lambda i: ((i > 0) & equal(F.get(keys, i), F.get(keys, i - 1)))
            | ((i < last) & equal(F.get(keys, i), F.get(keys, i + 1))),
        )

    def short(key: Column) -> Column:
        return F.shiftright(key, bits)

    def fast(h: Column) -> Column:
        keys = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))

        def at(key: Column) -> Column:
            return key.bitwiseAND(F.lit(low)).cast("int")

        def pick(keys: Column) -> Column:
            twice = same_pairs(keys, lambda a, b: short(a) == short(b))
            clash = F.exists(
                twice,
                lambda i: (i > 0)
                & (short(F.get(keys, i)) == short(F.get(keys, i - 1)))
                & (F.get(h, at(F.get(keys, i))) != F.get(h, at(F.get(keys, i - 1)))),
            )
            return F.when(clash, F.lit(None)).otherwise(
                covered(F.sort_array(F.transform(twice, lambda i: at(F.get(keys, i)))))
            )

        return _let(keys, pick)

    def slow(h: Column) -> Column:
        keys = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def pick(keys: Column) -> Column:
            twice = same_pairs(keys, lambda a, b: a["x"] == b["x"])
            return covered(F.sort_array(F.transform(twice, lambda i: F.get(keys, i)["i"])))

        return _let(keys, pick)

    both = _let(hashes, lambda h: F.coalesce(F.when(count <= low, fast(h)), slow(h)))
    return F.when(count < 2, F.lit(0)).otherwise(both).cast("long")


def _let(value: Column, body) -> Column:
    """Bind ``value`` once for several uses in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def counts(docs: DataFrame) -> DataFrame:
    """Add what the rules look at to ``docs`` (text); row-local, whole texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\x0c\r")) != "")
    without = F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")
    no_symbols = F.regexp_replace(text, "[#*$%&|<>]+", "")
    return (
        docs.withColumn("_words", words(F.col("text")))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.char_length(without).cast("long"))
        .withColumn("n_symbols", (F.char_length(text) - F.char_length(no_symbols)).cast("long"))
        .withColumn("_lines", lines)
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_repeat_words", repeat_words(F.col("_words")))
        .withColumn("n_upper", F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long"))
        .withColumn("n_lower", F.char_length(F.regexp_replace(text, "[^a-z]+", "")).cast("long"))
        .withColumn("n_ends", F.regexp_count(text, F.lit(r"[.?]")).cast("long"))
        .withColumn("n_exclamations", F.regexp_count(text, F.lit("!")).cast("long"))
        .withColumn("n_symbol_words", F.size(F.filter("_words", lambda w: F.rlike(w, F.lit(r"[#*$%&|<>]")))).cast("long"))
        .withColumn("n_bars", F.regexp_count(text, F.lit(r"\|")).cast("long"))
        .drop("_words", "_lines")
    )


def votes() -> list[Column]:
    """The vote of every rule in the order of ``RULES``; all abstain on a text without a word."""
    n = F.col("n_words")
    letters = F.col("n_upper") + F.col("n_lower")

    def bad(seen: Column) -> Column:
        return F.when((n > 0) & seen, -1).otherwise(0).cast("int")

    prose = (
        (F.col("n_symbols") * 100 < n) & (F.col("n_upper") * 5 < letters) & (F.col("n_exclamations") * 20 < n)
        & (F.col("n_repeat_words") * 10 < n) & F.col("n_ends").between(n / 60, n / 2)
        & F.col("word_chars").between(n * 2, n * 14)
    )
    return [
        bad(F.col("n_symbols") * 10 > n),
        bad(F.col("n_symbol_words") * 5 > n),
        bad(F.col("n_upper") * 2 > letters),
        bad(F.col("n_exclamations") * 5 > n),
        bad(F.col("n_bars") * 10 > n * 3),
        bad(F.col("n_ends") * 60 < n),
        bad(F.col("n_repeat_words") * 10 > n * 3),
        bad(F.col("n_dup_lines") * 2 > F.col("n_lines")),
        F.when((n > 0) & prose, 1).otherwise(0).cast("int"),
    ]


def posterior(prior: float, right: list[float], at=lambda j: F.get("votes", F.lit(j))) -> Column:
    """Probability of a good document, given its votes and the accuracy of each rule."""
    odds = reduce(
        lambda a, b: a + b,
        (at(j).cast("double") * math.log(accuracy / (1 - accuracy)) for j, accuracy in enumerate(right)),
        F.lit(math.log(prior / (1 - prior))),
    )
    return 1 / (1 + F.exp(-odds))


def estimate(
    patterns: DataFrame, rules: int = len(RULES), rounds: int = ROUNDS, pseudo_votes: float = PSEUDO_VOTES
) -> tuple[float, list[float]]:
    """EM over ``patterns`` (votes, n): share of good documents, and the accuracy of each rule where it votes.

    A round is one aggregate of the pattern table to one row.  Without any vote
    the start values stay.
    """
    prior, right = START_GOOD, [START] * rules

    def kept(value: float) -> float:
        return min(1 - MARGIN, max(MARGIN, value))

    for _ in range(rounds):
        sums = [F.sum(F.col("n") * F.col("good")).alias("good"), F.sum("n").alias("n")]
        for j in range(rules):
            vote = F.get("votes", F.lit(j))
            agree = F.when(vote == 1, F.col("good")).when(vote == -1, 1 - F.col("good"))
            sums += [F.sum(F.col("n") * agree).alias(f"a{j}"), F.sum(F.when(vote != 0, F.col("n"))).alias(f"v{j}")]
        row = patterns.withColumn("good", posterior(prior, right)).agg(*sums).first()
        if not row["n"]:
            break
        prior = kept(row["good"] / row["n"])
        right = [
            kept((row[f"a{j}"] + pseudo_votes * START) / (row[f"v{j}"] + pseudo_votes)) if row[f"v{j}"] else right[j]
            for j in range(rules)
        ]
    return prior, right


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Counts, votes and verdict of each row of ``docs`` (doc_id, text).

    Returns doc_id, the counts, ``votes``, ``posterior``, ``base_failed`` (under
    50 words, or more than half of the words in repeated windows) and ``kept``:
    not ``base_failed``, and a posterior of at least ``threshold``.  NULL is a
    text without words; there all rules abstain and ``base_failed`` is true.
    Repeated rows each get their row and count each; other columns are not read.
    An empty table gives no rows.
    """
    n = F.col("n_words")
    voted = land(
        counts(docs.select("doc_id", "text")).drop("text").withColumn("votes", F.array(*votes())), "quality-votes"
    )
    patterns = land(voted.groupBy("votes").agg(F.count("*").alias("n")), "quality-patterns")
    prior, right = estimate(patterns)
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    return (
        voted.withColumn("posterior", posterior(prior, right))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("posterior") >= threshold))
    )


def digest(docs: DataFrame) -> DataFrame:
    """The counts of the base rules and both verdicts of each row of ``docs``.

    NULL, empty and blank texts have counts of 0 and fail the base; long texts
    are counted whole; repeated rows each get their row; ties at a threshold are
    kept; other columns are not read; an empty table gives no rows.
    """
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
