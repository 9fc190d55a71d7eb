"""Report writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.operators.metrics import scores_summary
from answerloom.operators.runs import per_example
from answerloom.sources.exact import write_lines
from answerloom.sources.runs import WRITE_OPTIONS


def write_scores(graded: DataFrame, path: str) -> None:
    """The summary as one JSON object (one row, hence one file)."""
    scores_summary(graded).coalesce(1).write.mode("overwrite").json(path)


def write_per_example(graded: DataFrame, path: str) -> None:
    """One JSON object per graded run; text outside ASCII is written as it is.

    Every field is filled, so no key is ever missing from a line.
    """
    per_example(graded).write.mode("overwrite").json(path)


def write_graded(graded: DataFrame, path: str) -> None:
    """The whole graded run table as CSV, for readers without Parquet."""
    graded.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def write_report_files(graded: DataFrame, out_dir: str, parts: int = 1) -> None:
    """``scores.json`` and ``per_example.jsonl`` as single files of these names.

    A large table goes to ``parts`` files ``per_example-{i}of{n}.jsonl``, each
    written by one task.
    """
    summary = scores_summary(graded)
    write_lines(summary.select(F.lit("scores.json").alias("file"), F.to_json(F.struct("*")).alias("line")), out_dir)
    records = per_example(graded)
    keys = list(records.columns)
    name = (
        F.lit("per_example.jsonl") if parts == 1
        else F.concat(F.lit("per_example-"), F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("string"), F.lit(f"of{parts}.jsonl"))
    )
    lines = records.select(*keys, name.alias("file"), F.to_json(F.struct(*keys)).alias("line"))
    write_lines(lines, out_dir, "example_id", "method", "seed", "line")
