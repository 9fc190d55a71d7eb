"""Sweep results: one directory per setting, the setting only in its name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.sources.schemas import PER_EXAMPLE_SCHEMA


def read_sweep(
    spark: SparkSession,
    root: str,
    setting: str = "n_mcmc",
    directory: str = "nmcmc_",
    file: str = "per_example.jsonl",
) -> DataFrame:
    """Per-example records of all settings, with the setting as an INT column."""
    value = F.regexp_extract("_metadata.file_path", rf"/{directory}(\d+)/", 1)
    return (
        spark.read.schema(PER_EXAMPLE_SCHEMA)
        .json(f"{root}/{directory}*/{file}")
        .select(value.cast("int").alias(setting), "*")
    )
