"""Splitting a problem set into shards by row position."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from answerloom.functions.columns import let


def natural(name: Column) -> Column:
    """Sort key of a file name in which numbers count as numbers: ``part-99999`` comes before ``part-100000``."""
    pieces = F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(
        F.transform(pieces, lambda x: F.when(F.rlike(x, F.lit(r"^\d")), F.lpad(x, 24, "0")).otherwise(x)), ""
    )


def _numbered(tagged: DataFrame, part: str, order: Column, out: str) -> DataFrame:
    """Position of each row: its ``_row`` in its ``part``, plus the rows of all earlier parts.

    The counts are one row per part, and one task adds them up; they are as
    many as tasks or files have written the table.
    """
    counts = tagged.groupBy(part).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return tagged.join(offsets, part).withColumn(out, F.col("_row") + F.col("_before")).drop(part, "_row", "_before")


def with_file_position(
    spark: SparkSession, path: str, out: str = "position", columns: list[str] | None = None
) -> DataFrame:
    """Read Parquet with each row's 0-based position in file order.

    Files count in natural name order, rows as stored.  No row is sorted, and
    none is shuffled while Spark measures the counts per file as small enough
    to broadcast.
    """
    rows = spark.read.parquet(path)
    tagged = rows.select(
        *(columns or rows.columns),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    return _numbered(tagged, "_file", natural(F.col("_file")), out)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; the warehouse where it names none, as in tests."""
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    ).rstrip("/")


# A range holds about so many rows, and there are never more ranges than that.
RANGE_ROWS, MOST_RANGES = 1 << 17, 4096
# Keys drawn for each range, from which the cuts between ranges are taken.
DRAWN = 20


def range_cuts(df: DataFrame, order: Sequence[str], range_rows: int = RANGE_ROWS, most: int = MOST_RANGES) -> list[Row]:
    """Keys that cut ``df`` into ranges of about ``range_rows`` rows; at most ``most - 1``, in order, each once.

    They are drawn from a random sample, of which ``DRAWN`` keys for each range
    reach the driver: a bound that does not depend on the table.
    """
    total = df.count()
    ranges = min(-(-total // range_rows), most)
    if ranges <= 1:
        return []
    wanted = ranges * DRAWN
    keys = df.select(*order).sample(min(1.0, wanted / total), seed=7).sort(*order).limit(2 * wanted).collect()
    cuts = keys[DRAWN::DRAWN][: ranges - 1]
    return [cut for k, cut in enumerate(cuts) if not k or cut != cuts[k - 1]]


def range_of(order: Sequence[str], cuts: Sequence[Row], schema: StructType) -> Column:
    """The range of a row: the number of cuts up to its key, found in two steps of about the root of all cuts."""
    if not cuts:
        return F.lit(0)
    key = F.struct(*order)

    def literal(cut: Row) -> Column:
        return F.struct(*(F.lit(v).cast(schema[name].dataType).alias(name) for name, v in zip(order, cut)))

    width = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[k : k + width] for k in range(0, len(cuts), width)]
    firsts = F.array(*(literal(g[0]) for g in groups))
    rests = F.array(*(F.array(*map(literal, g)) for g in groups))

    def upto(some: Column, value: Column) -> Column:
        return F.size(F.filter(some, lambda cut: cut <= value))

    def found(value: Column) -> Column:
        return let(
            upto(firsts, value),
            lambda g: F.when(g == 0, F.lit(0)).otherwise((g - 1) * width + upto(F.get(rests, g - 1), value)),
        )

    return let(key, found)


def with_position(
    df: DataFrame, *order: str, out: str = "position", range_rows: int = RANGE_ROWS, most_ranges: int = MOST_RANGES
) -> DataFrame:
    """Each row's dense 0-based position in the given order, which must tell all rows apart.

    The table is counted and cuts between ranges of keys are drawn when the
    function is called; both read the keys alone.  After that nothing is written
    and nothing random is left: the rows of each range are counted in one small
    table, and a row's position is its place in its range plus the rows of the
    ranges before it.  A range is what one task sorts; a task that runs again
    gives the same positions.
    """
    cuts = range_cuts(df, order, range_rows, most_ranges)
    if not cuts:  # a single range
        return df.withColumn(out, (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint"))
    ranged = df.withColumn("_range", range_of(order, cuts, df.schema))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # at most most_ranges rows
    offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_range").orderBy(*order)
    placed = ranged.withColumn("_row", F.row_number().over(within) - 1)
    return (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_row") + F.col("_before")).drop("_range", "_row", "_before")
    )


def take_shard(
    positioned: DataFrame,
    shard_id: int,
    num_shards: int,
    max_examples: int = 0,
    position: str = "position",
) -> DataFrame:
    """Rows of one shard (position modulo ``num_shards``), at most ``max_examples``.

    0 keeps all.  Row j of a shard sits at position ``j * num_shards + shard_id``,
    so the head of a shard is a filter too, not a sort.
    """
    if not 0 <= shard_id < num_shards:
        raise ValueError(f"shard_id must be in 0..{num_shards - 1}, got {shard_id}")
    shard = positioned.filter(F.pmod(F.col(position), F.lit(num_shards)) == shard_id)
    if max_examples > 0:
        shard = shard.filter(F.col(position) < max_examples * num_shards)
    return shard
