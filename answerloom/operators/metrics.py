"""Accuracy summaries of a graded run table.

All of them reduce to counts per (method, seed) first.  Those partial counts
are combined map-side, so a hot method or seed costs no more than a cold one,
and everything after them works on a table of a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sampling methods in report order.
METHODS = ("base", "lowtemp", "power_mh")


def accuracy_overall(graded: DataFrame, correct: str = "correct_eval") -> DataFrame:
    """Row count and mean grade; 0.0 when there are no rows."""
    return graded.agg(
        F.count("*").alias("n"), F.coalesce(F.avg(correct), F.lit(0.0)).alias("accuracy")
    )


def accuracy_by(
    graded: DataFrame, *keys: str, correct: str = "correct_eval"
) -> DataFrame:
    """Row count and mean grade per key; rows without a key are left out."""
    return (
        graded.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("n"), F.avg(correct).alias("accuracy"))
    )


def accuracy_cube(graded: DataFrame, correct: str = "correct_eval") -> DataFrame:
    """Overall, per method and per seed in long form, from one scan.

    Columns ``level`` ('all', 'method', 'seed'), ``key``, ``n``, ``accuracy``.
    The grouping sets run over the counts, not over the rows, so the rows are
    neither tripled nor shuffled.
    """
    counts = graded.groupBy("method", "seed").agg(
        F.count("*").alias("n"), F.count(correct).alias("graded"), F.sum(correct).alias("c")
    )
    level = F.expr("CASE grouping_id() WHEN 1 THEN 'method' WHEN 2 THEN 'seed' ELSE 'all' END")
    sets = counts.groupingSets(
        [["method"], ["seed"], []], F.col("method"), F.col("seed")
    ).agg(
        level.alias("level"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum("graded").alias("graded"),
        F.sum("c").alias("c"),
    )
    key = F.when(F.col("level") == "method", F.col("method")).when(
        F.col("level") == "seed", F.col("seed").cast("string")
    )
    # As in the averages: a NULL grade counts as a row, not as wrong; a group without any grade has none.
    mean = F.when(F.col("graded") > 0, F.col("c") / F.col("graded"))
    accuracy = F.when(F.col("level") == "all", F.coalesce(mean, F.lit(0.0))).otherwise(mean)
    return (
        sets.select(
            "level", key.alias("key"), "n", accuracy.alias("accuracy")
        ).filter((F.col("level") == "all") | F.col("key").isNotNull())
    )


def scores_summary(graded: DataFrame, correct: str = "correct_eval") -> DataFrame:
    """The report as one row: ``n``, ``accuracy`` and a map per method and seed.

    The maps hold one entry per method and per seed, nothing per row.
    """
    cube = accuracy_cube(graded, correct)

    def as_map(level: str) -> Column:
        entry = F.when(F.col("level") == level, F.struct("key", "accuracy"))
        return F.map_from_entries(F.array_sort(F.collect_list(entry)))

    def overall(name: str) -> Column:
        return F.max(F.when(F.col("level") == "all", F.col(name)))

    return cube.agg(
        F.coalesce(overall("n"), F.lit(0)).alias("n"),
        F.coalesce(overall("accuracy"), F.lit(0.0)).alias("accuracy"),
        as_map("method").alias("accuracy_by_method"),
        as_map("seed").alias("accuracy_by_seed"),
    )


def distinct_examples(runs: DataFrame) -> DataFrame:
    """Number of different examples; NULL does not count."""
    return runs.agg(F.count_distinct("example_id").alias("n_examples"))


def method_series(
    graded: DataFrame, labels: Sequence[str] = METHODS, correct: str = "correct_eval"
) -> DataFrame:
    """Accuracy in percent for a fixed list of methods, 0 for absent ones."""
    wanted = graded.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(label) for label in labels])).alias("position", "method")
    )
    found = accuracy_by(graded, "method", correct=correct)
    percent = F.coalesce(F.col("accuracy") * 100.0, F.lit(0.0))
    return wanted.join(found, "method", "left").select(
        "position", "method", percent.alias("accuracy_pct")
    )


def sweep_accuracy(
    graded: DataFrame, setting: str = "n_mcmc", correct: str = "correct_eval"
) -> DataFrame:
    """Accuracy in percent per value of a swept setting."""
    return accuracy_by(graded, setting, correct=correct).select(
        setting, "n", (F.col("accuracy") * 100.0).alias("accuracy_pct")
    )
