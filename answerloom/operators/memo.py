"""Grades that are kept between runs.

A memo is a folder of Parquet tables, one for each batch that brought new pairs:
``key`` (a 64-bit hash of the pair), ``pred``, ``gold``, ``grade``.  An
evaluation grades only the pairs that no batch has.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from answerloom.operators.filters import FILTER_BITS, key_filter, maybe_in
from answerloom.operators.grading import extract_answers, with_match
from answerloom.operators.sharding import shared_folder

SCHEMA = "key BIGINT, pred STRING, gold STRING, grade INT"


def pair_key(pred: Column, gold: Column) -> Column:
    """A hash of the pair in which a NULL differs from any text."""
    return F.xxhash64(F.coalesce(pred, F.lit("")), pred.isNull(), F.coalesce(gold, F.lit("")), gold.isNull())


def read_memo(spark: SparkSession, path: str) -> DataFrame:
    """All pairs of the memo, each once; an empty table where nothing has been kept yet."""
    try:
        rows = spark.read.schema(f"{SCHEMA}, batch STRING").option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)
    return rows.drop("batch")


def _same_pair(left: DataFrame, right: DataFrame) -> Column:
    return (
        (left["key"] == right["key"]) & left["pred"].eqNullSafe(right["pred"]) & left["gold"].eqNullSafe(right["gold"])
    )


def new_pairs(pairs: DataFrame, path: str, bits: int = FILTER_BITS) -> DataFrame:
    """The ``pairs`` (key, pred, gold; distinct) that the memo at ``path`` does not have.

    The memo is narrowed to what may be among the pairs before anything of it
    is shuffled, so a small batch against a large memo costs one scan of it.
    """
    known = maybe_in(read_memo(pairs.sparkSession, path).select("key", "pred", "gold"), key_filter(pairs, bits), bits)
    return pairs.join(known, _same_pair(pairs, known), "left_anti")


def _distinct_pairs(extracted: DataFrame, pred: str, gold: str) -> DataFrame:
    return extracted.select(
        pair_key(F.col(pred), F.col(gold)).alias("key"), F.col(pred).alias("pred"), F.col(gold).alias("gold")
    ).distinct()


def _written(table: DataFrame) -> DataFrame:
    """``table``, written to the shared folder and read from there."""
    path = f"{shared_folder(table.sparkSession)}/memo-{uuid.uuid4().hex}"
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def remember(pairs: DataFrame, path: str, batch: str, bits: int = FILTER_BITS) -> int:
    """Grade the pairs that the memo lacks, add them to its table ``batch``, and give their number.

    A job that is started again finds what an earlier try has added and adds the
    rest, so nothing is there twice.
    """
    fresh = with_match(new_pairs(pairs, path, bits), "pred", "gold", "grade").select("key", "pred", "gold", "grade")
    seen = Observation()
    fresh.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(f"{path}/batch={batch}")
    return seen.get["n"]


def grade_runs_with_memo(
    runs: DataFrame, path: str, batch: str, completion: str = "completion", gold: str = "gold"
) -> DataFrame:
    """As :func:`grading.grade_runs`, but every pair that the memo at ``path`` knows is looked up, not graded.

    New pairs are graded and added as ``batch`` when the function is called.  NULL and empty texts are values like
    others.  The distinct pairs and then their grades are written once, so
    answers are extracted for the pairs and for the result only, and Spark knows
    how large the grades are: few are broadcast and no run moves, many are joined
    by a shuffle.  A pair that many runs share is one row here and there, and
    adaptive execution splits its runs.
    """
    spark = runs.sparkSession
    extracted = extract_answers(runs, completion)
    pairs = _written(_distinct_pairs(extracted, "pred_eval", gold))
    remember(pairs, path, batch)
    known = _written(
        maybe_in(read_memo(spark, path), key_filter(pairs)).dropDuplicates(["key", "pred", "gold"]).select(
            F.col("key").alias("_key"), F.col("pred").alias("_pred"), F.col("gold").alias("_gold"), F.col("grade").alias("correct_eval")
        )
    )
    keyed = extracted.withColumn("_of", pair_key(F.col("pred_eval"), F.col(gold)))
    same = (F.col("_of") == F.col("_key")) & F.col("pred_eval").eqNullSafe(F.col("_pred")) & F.col(gold).eqNullSafe(F.col("_gold"))
    return keyed.join(known, same, "left").drop("_of", "_key", "_pred", "_gold")
