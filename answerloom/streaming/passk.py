"""pass@k and accuracy that follow arriving runs without reading earlier ones again.

The state of an example is three numbers, whatever the number of its samples.
Each batch turns into changes of the histogram (method, n, c): one example less
where it was, one more where it is now.  The histogram is small, so a new
version of it is written for each batch, and the curve is computed from it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from answerloom.operators.passk import grid_of_shapes

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

SHAPES = "method STRING, n BIGINT, c BIGINT, examples BIGINT"


def _changes(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Samples of one example -> its old place in the histogram with -1, its new one with +1."""
    old = state.get if state.exists else (0, 0, 0)
    n, graded, c = old
    for batch in batches:
        grades = batch["correct"].dropna()
        n, graded, c = n + len(batch), graded + len(grades), c + int(grades.sum())
    state.update((n, graded, c))
    rows = [(*place, change) for place, change in ((old, -1), ((n, graded, c), 1)) if place[0]]
    yield pd.DataFrame(
        {
            "method": [key[0]] * len(rows),
            "n": [r[0] for r in rows],
            "c": pd.array([r[2] if r[1] else None for r in rows], "Int64"),  # as in a sum: unknown without any grade
            "examples": [r[3] for r in rows],
        }
    )


def shape_changes(graded: DataFrame, correct: str = "correct_eval") -> DataFrame:
    """Changes (method, n, c, examples) of the histogram for a stream of graded runs; rows without a key are left out."""
    rows = graded.dropna(subset=["method", "example_id"]).select("method", "example_id", F.col(correct).cast("int").alias("correct"))
    return rows.groupBy("method", "example_id").applyInPandasWithState(
        _changes, SHAPES, "n BIGINT, graded BIGINT, c BIGINT", "update", GroupStateTimeout.NoTimeout
    )


def latest_shapes(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The newest version of the histogram at ``path``, or the newest ``before`` a batch; empty if there is none."""
    try:
        versions = spark.read.schema(f"{SHAPES}, version BIGINT").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SHAPES)
    if before is not None:
        versions = versions.filter(F.col("version") < before)
    newest = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == newest).drop("version") if newest is not None else spark.createDataFrame([], SHAPES)


def follow_pass_at_k(graded: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take what has arrived into the histogram at ``path``, then stop.

    Each batch writes a version of its own from the version before it, so a
    batch that is run again after a failure gives the same version.  Samples
    may come in any order and at any time.
    """

    def merge(changes: DataFrame, batch: int) -> None:
        spark = changes.sparkSession
        merged = latest_shapes(spark, path, before=batch).unionByName(changes).groupBy("method", "n", "c").agg(F.sum("examples").alias("examples"))
        merged.filter("examples <> 0").write.mode("overwrite").parquet(f"{path}/version={batch}")

    return (
        shape_changes(graded).writeStream.outputMode("update").foreachBatch(merge)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def pass_at_k_so_far(spark: SparkSession, path: str, max_k: int) -> DataFrame:
    """``method, k, examples, pass_at_k`` of everything taken in so far."""
    return grid_of_shapes(latest_shapes(spark, path), max_k).filter(F.col("pass_at_k").isNotNull())
