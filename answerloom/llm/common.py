"""Small helpers that the operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of words as BIGINT; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words in order; an empty array for NULL, empty or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` names it; where that is unset, as in tests, the
    warehouse is taken, which all executors must be able to reach anyway.
    """
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; whoever owns the folder empties it."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the files, so that a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores before it as keep it clear of ``columns`` (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ranked(rows: DataFrame, group: list[str], order: list[Column], out: str, total: str, name: str) -> DataFrame:
    """Add the 0-based place ``out`` of each row in its group, and the group's rows as ``total``.

    The rows are range-partitioned by group and order, sorted and written; a
    row's place is its place in its partition plus the group's rows in earlier
    ones.  So a group may span any number of tasks, and only one row for each
    group and partition is counted.  NULL is a group like any other.
    """
    keys = [*map(F.col, group), *order]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else rows
    placed = land(sorted_rows.withColumns({"_part": F.spark_partition_id(), "_row": place}), name)
    counts = placed.groupBy(*group, "_part").agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *(F.col(g).alias(f"_of_{g}") for g in group),
        F.col("_part").alias("_of_part"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias(total),
    )
    same = F.col("_part") == F.col("_of_part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return placed.join(offsets, same).withColumn(out, F.col("_row") + F.col("_shift")).drop(
        "_part", "_row", "_of_part", "_shift", *(f"_of_{g}" for g in group)
    )
