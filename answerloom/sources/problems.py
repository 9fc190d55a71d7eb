"""Problem sets: JSON lines, one problem per line."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.operators.sharding import natural
from answerloom.sources.exact import write_lines
from answerloom.sources.schemas import PROBLEM_SCHEMA


# Where a line stood: sorts like the files and their lines.
FILE_ORDER = ("_file_key", "_block", "_line")


def read_problems(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROBLEM_SCHEMA).json(path)


def read_problems_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Problems with the columns of ``FILE_ORDER``: file in natural name order, split, and line within it."""
    return spark.read.schema(PROBLEM_SCHEMA).json(path).select(
        "*",
        natural(F.col("_metadata.file_path")).alias(FILE_ORDER[0]),
        F.col("_metadata.file_block_start").alias(FILE_ORDER[1]),
        F.monotonically_increasing_id().alias(FILE_ORDER[2]),
    )


def _has_lines(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.text(path).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def cache_problems(problems: DataFrame, path: str) -> DataFrame:
    """Write once: keep what is at ``path`` unless it is missing or empty.

    The problems, a set for one benchmark, become the one file
    ``problems.jsonl`` there, moved into place when it is complete.  So of two
    jobs that find nothing the later one replaces the earlier one's file by its
    own whole one, and no reader sees half a set or both.
    """
    spark = problems.sparkSession
    if not _has_lines(spark, path):
        order = [F.col(c).asc_nulls_last() for c in problems.columns]
        lines = problems.select("*", F.lit("problems.jsonl").alias("file"), F.to_json(F.struct(*problems.columns)).alias("line"))
        write_lines(lines, path, *order)
    return read_problems(spark, path)
