"""pass@k over repeated samples of the same example."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.functions.estimators import pass_at_k


def outcome_counts(graded: DataFrame, correct: str = "correct_eval") -> DataFrame:
    """Samples ``n`` and correct samples ``c`` per (method, example).

    Only the counts are needed, so no list of outcomes is ever built, and a
    very often sampled example is combined map-side.
    """
    return (
        graded.dropna(subset=["method", "example_id"])
        .groupBy("method", "example_id")
        .agg(F.count("*").alias("n"), F.sum(F.col(correct).cast("long")).alias("c"))
    )


def pass_at_k_per_example(counts: DataFrame, max_k: int) -> DataFrame:
    """One row per (method, example, k); NULL where n < k."""
    ks = F.explode(F.sequence(F.lit(1), F.lit(max_k))).alias("k")
    return counts.select("method", "example_id", "n", "c", ks).withColumn(
        "pass_at_k", pass_at_k(F.col("n"), F.col("c"), F.col("k"))
    )


def outcome_shapes(counts: DataFrame) -> DataFrame:
    """How many examples each method has with ``n`` samples, ``c`` of them correct."""
    return counts.groupBy("method", "n", "c").agg(F.count("*").alias("examples"))


def grid_of_shapes(shapes: DataFrame, max_k: int) -> DataFrame:
    """Mean pass@k per (method, k) of ``shapes`` (method, n, c, examples), NULL where no example has k samples.

    pass@k depends on (n, c) only, so the k values are unfolded over this small
    table instead of over every example.
    """
    points = shapes.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(max_k))).alias("k")
    ).withColumn("value", pass_at_k(F.col("n"), F.col("c"), F.col("k")))
    usable = F.when(F.col("value").isNotNull(), F.col("examples"))
    return points.groupBy("method", "k").agg(
        F.coalesce(F.sum(usable), F.lit(0)).alias("examples"),
        (F.sum(F.col("value") * F.col("examples")) / F.sum(usable)).alias("pass_at_k"),
    )


def pass_at_k_grid(counts: DataFrame, max_k: int) -> DataFrame:
    """Mean pass@k per (method, k), NULL where no example has k samples."""
    return grid_of_shapes(outcome_shapes(counts), max_k)


def pass_at_k_curve(counts: DataFrame, max_k: int) -> DataFrame:
    """The grid without the points that no example supports."""
    return pass_at_k_grid(counts, max_k).filter(F.col("pass_at_k").isNotNull())
