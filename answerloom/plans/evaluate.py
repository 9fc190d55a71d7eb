"""Re-grade runs and report accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from answerloom.operators.grading import grade_runs
from answerloom.sources.runs import land_runs, read_landed, read_runs
from answerloom.sources.schemas import GRADED_FIELDS, RUN_SCHEMA
from answerloom.sources.sinks import write_graded, write_per_example, write_scores


def grade_and_land(
    spark: SparkSession, run_paths: list[str], graded_path: str, contains: str = ""
) -> DataFrame:
    """Merge run files, grade them once, and keep the result as Parquet.

    Accuracy and pass@k both start from this table, so completions are read
    and graded a single time and later jobs scan two narrow columns.
    """
    graded = grade_runs(read_runs(spark, *run_paths, contains=contains))
    land_runs(graded, graded_path)
    return read_landed(spark, graded_path, f"{RUN_SCHEMA}, {GRADED_FIELDS}")


def evaluate(graded: DataFrame, out_dir: str, graded_csv: bool = False) -> None:
    """Write the scores, the per-example records and, if asked, the full table."""
    write_scores(graded, f"{out_dir}/scores.json")
    write_per_example(graded, f"{out_dir}/per_example.jsonl")
    if graded_csv:
        write_graded(graded, f"{out_dir}/merged_with_eval.csv")
