"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Each source is a line of tokens: its documents in seeded order, one behind the
other, cut into blocks of ``block_words`` tokens.  Blocks are seats and sources
are parties: the next seat always goes to the source with the highest quotient
``target / (2 * seats + 1)``.  The seats make ``shards`` shards of the mix of equal
size, the first ones shard 0, the next ones shard 1, and so on; since more seats
never take one away from a source, each shard's quota is the difference between
two apportionments.  A shard then takes its quota from each source as the next
blocks of that line, which is in seeded order and starts over at its end.

Nothing here walks seat by seat.  If ``n`` sources share ``h`` seats, the divisor
lies within ``n / 2`` seats of ``h``, so all but about four seats of each source
are certain and only those few quotients are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.llm.common import land, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Hex digits of the seeded key that form a bucket: a bucket is what one task orders.
BUCKET_DIGITS = 3
ADDED = ("source_size", "weight", "target", "passes", "taken", "shards")


def cycled_weights(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes`` (source, source_size) with ``rank`` by code point, NULL last, and a repeating ``weight``.

    One row per source goes through one task here and in ``capped_targets``.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    return ranked.withColumn(
        "weight", F.get(F.array(*map(F.lit, weights)), F.col("rank") % len(weights)).cast("long")
    )


def capped_targets(weighted: DataFrame, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Add ``target``: ``share`` of all tokens by weight, none above ``cap`` times its source.

    The level (tokens per unit of weight) rises while sources fill up in the
    order of cap per weight and falls afterwards, so the final level is the
    highest one on the way.
    """
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("_most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    budget = share * F.sum("source_size").over(everything)
    level = (budget - F.coalesce(F.sum("_most").over(filled), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0))
    )
    return (
        weighted.withColumn("_most", cap * F.col("source_size"))
        .withColumn("_level", level)
        .withColumn("target", F.least("_most", F.max("_level").over(everything) * F.col("weight")))
        .drop("_most", "_level")
    )


def apportion(parties: DataFrame) -> DataFrame:
    """Sainte-Lague seats of every party for every house size.

    ``parties``: rank, target and ``houses``, the same array of seat numbers on
    each row.  Returns house, rank, seats.  Equal quotients go to the lower rank.
    """
    everything = Window.partitionBy()

    def rounded(shift: Column) -> Column:
        return F.floor(F.col("target") * (F.col("house") + shift) / F.col("_total") + 0.5)

    quotients = (
        parties.filter("target > 0")
        .withColumn("_total", F.sum("target").over(everything))
        .withColumn("_n", F.count("*").over(everything))
        .withColumn("house", F.explode("houses"))
        .withColumn("_sure", F.greatest(F.lit(0), rounded(-F.col("_n") / 2) - 1))
        .withColumn("_seat", F.explode(F.sequence("_sure", rounded(F.col("_n") / 2) + 1)))
        .withColumn("_quotient", F.col("target") / (2 * F.col("_seat") + 1))
    )
    by_quotient = Window.partitionBy("house").orderBy(F.desc("_quotient"), "rank", "_seat")
    first_seat = F.when(F.col("_seat") == F.col("_sure"), F.col("_sure"))
    ranked = quotients.withColumn("_place", F.row_number().over(by_quotient)).withColumn(
        "_open", F.col("house") - F.sum(first_seat).over(Window.partitionBy("house"))
    )
    won = F.sum((F.col("_place") <= F.col("_open")).cast("long"))
    return ranked.groupBy("house", "rank").agg((F.min("_sure") + won).alias("seats"))


def shard_quotas(targets: DataFrame, block_words: int = 16, shards: int = 64) -> DataFrame:
    """Blocks that each shard of the mix takes from each source: shard, rank, quota, through (running total).

    Shards have equally many blocks, but for the last that has any.
    """
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long")
    numbers = F.sequence(F.lit(1), F.ceil(F.col("_blocks") / F.col("_each")))
    parties = (
        targets.withColumn("_blocks", blocks)
        .filter("_blocks > 0")
        .withColumn("_each", F.ceil(F.col("_blocks") / shards))
        .withColumn("houses", F.transform(numbers, lambda k: F.least(k * F.col("_each"), F.col("_blocks"))))
    )
    seats = apportion(parties.drop("_blocks", "_each"))
    earlier = F.lag("seats", 1, 0).over(Window.partitionBy("rank").orderBy("house"))
    return seats.select(
        (F.dense_rank().over(Window.partitionBy("rank").orderBy("house")) - 1).alias("shard"),
        "rank",
        (F.col("seats") - earlier).alias("quota"),
        F.col("seats").alias("through"),
    )


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    block_words: int = 16,
    shards: int = 64,
    seed: int = 7,
) -> DataFrame:
    """Add to each row of ``docs`` (doc_id, text, source) what the mix takes of it.

    Columns added: ``size`` (words of the text), ``source_size``, ``weight``,
    ``target`` (of its source), ``passes`` (how often a pass takes any of its
    words), ``taken`` (words taken, repeats counted) and ``shards`` (for each
    pass the shard of the mix whose quota takes the first of these words).
    Columns of these names in ``docs`` are replaced, others kept.

    NULL and empty texts have size 0 and are taken 0 times.  NULL is a source of
    its own, the last.  Repeated rows lie side by side and count each.  A tie in
    the seeded order is broken by doc_id and size, so it cannot change the
    result.  A source's taken words are within a block or so of its target, and
    never above ``cap`` times its size for ``cap`` a whole number.  An empty
    table stays empty.
    """
    kept = [c for c in docs.columns if c not in {"size", *ADDED}]
    sized = docs.select(*kept, word_count(F.col("text")).alias("size")) if "text" in kept else docs
    return mix_sized(
        sized, weights=weights, share=share, cap=cap, block_words=block_words, shards=shards, seed=seed
    )


def mix_sized(
    sized: DataFrame,
    *,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    block_words: int = 16,
    shards: int = 64,
    seed: int = 7,
) -> DataFrame:
    """``mix`` for rows that carry their ``size`` already."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = sized.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    buckets = land(
        keyed.groupBy("source", "_bucket").agg(F.sum("size").alias("_words")), "mix-buckets"
    )  # one row per source and bucket: at most 4,096 a source
    sizes = buckets.groupBy("source").agg(F.sum("_words").alias("source_size"))
    targets = land(capped_targets(cycled_weights(sizes, weights), share, cap), "mix-targets")
    totals = shard_quotas(targets, block_words, shards).groupBy("rank").agg(
        (F.sum("quota") * block_words).alias("_budget"), F.array_sort(F.collect_list("through")).alias("_through")
    )  # ``shards`` running totals for each source
    plans = targets.join(totals, "rank", "left").select(
        F.col("source").alias("_source"), "source_size", "weight", "target",
        F.coalesce("_budget", F.lit(0)).alias("_budget"), "_through",
    )
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    starts = offsets.join(plans, F.col("source").eqNullSafe(F.col("_source"))).select(
        "_source", F.col("_bucket").alias("_in"), "_before", "source_size", "weight", "target", "_budget", "_through"
    )
    line = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = (
        keyed.withColumn("_within", F.coalesce(F.sum("size").over(line), F.lit(0)))
        .join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_in")))
        .withColumn("_start", F.col("_before") + F.col("_within"))
    )

    def overlap(turn: Column) -> Column:
        """Words of the document's place in this turn of the line that lie below the budget."""
        return F.greatest(
            F.lit(0), F.least(F.col("size"), F.col("_budget") - turn * F.col("source_size") - F.col("_start"))
        )

    # Full turns first, then the part of the turn in which the budget ends.
    turns = F.least(
        F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0)), F.lit(cap).cast("long")
    )
    placed = placed.withColumn("_turns", turns).withColumn(
        "_rest", F.when(F.col("_turns") < F.lit(cap), overlap(F.col("_turns"))).otherwise(F.lit(0)).cast("long")
    )
    passes = F.when(F.col("size") > 0, F.col("_turns") + (F.col("_rest") > 0).cast("long")).otherwise(F.lit(0))

    def shard_of(turn: Column) -> Column:
        """The shard with the block that holds the row's first word in this turn of the line."""
        block = F.floor((turn * F.col("source_size") + F.col("_start")) / block_words)
        return F.size(F.filter("_through", lambda through: through <= block))

    turns_taken = F.when(F.col("passes") > 0, F.sequence(F.lit(0), F.col("passes") - 1)).otherwise(F.array().cast("array<bigint>"))
    kept = [c for c in sized.columns if c not in ADDED]
    return placed.withColumn("passes", passes).select(
        *kept,
        "source_size",
        "weight",
        "target",
        "passes",
        (F.col("_turns") * F.col("size") + F.col("_rest")).cast("long").alias("taken"),
        F.transform(turns_taken, shard_of).alias("shards"),
    )


def take(docs: DataFrame, shard: str | None = None, **settings: int | float) -> DataFrame:
    """The mix itself: each row of ``docs`` (doc_id, text, source, ...) once for every pass that takes any of its words.

    ``shard`` names a further column with the shard of the mix whose quota takes
    the pass; ``settings`` as for ``mix``.  Rows come whole and as they are, with
    columns of any name; a row that a budget ends in the middle of still comes.
    NULL, empty and blank texts have nothing to take and go.  NULL is a source,
    repeated rows come repeated, an empty table stays empty.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.struct("*").alias("row"))
    passes = mix_sized(rows, **settings).select("row", F.explode("shards").alias("at"))
    return passes.select("row.*", *([F.col("at").alias(shard)] if shard else []))
