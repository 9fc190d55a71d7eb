"""Run tables: CSV files as samplers write them, Parquet once landed."""

from __future__ import annotations

import csv
import os
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from answerloom.operators.runs import run_name
from answerloom.operators.sharding import shared_folder
from answerloom.sources.exact import write_lines
from answerloom.sources.schemas import GRADED_FIELDS, RUN_SCHEMA

# Completions hold line breaks and quotes, and quotes are doubled; spaces around
# a text belong to it.  Cells are read by place; what they are the header says.
WRITE_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
CSV_OPTIONS = {**WRITE_OPTIONS, "multiLine": True, "enforceSchema": True}
LOOKUP = {"recursiveFileLookup": True, "pathGlobFilter": "*.csv"}
KNOWN = dict(field.split() for field in f"{RUN_SCHEMA}, {GRADED_FIELDS}".split(","))  # name: type
# Up to so many files the list of them (some 30 MB then) goes to every task; beyond, Spark chooses the join.
FEW_FILES = 200_000
PARTITIONS = ("method", "seed", "shard_id")


def name_filter(contains: str) -> str:
    """Glob for CSV files with ``contains`` anywhere in the name."""
    literal = re.sub(r"([\\*?\[\]{}^])", r"\\\1", contains)
    return f"*{literal}*.csv" if literal else "*.csv"


def _typed(name: str, text: Column) -> Column:
    """A cell by its column's type; what is no such value is NULL, and columns that no schema knows stay text."""
    kind = KNOWN.get(name, "STRING")
    return (text if kind == "STRING" else text.try_cast(kind)).alias(name)


def _place(path: Column) -> Column:
    """A file's path without scheme and host, decoded."""
    return F.url_decode(F.replace(F.regexp_replace(path, r"\A[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", ""), F.lit("+"), F.lit("%2B")))


def _root(path: str) -> str:
    """The given path as ``_place`` shows it, up to its first wild card."""
    bare = re.sub(r"\A[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "", path)
    fixed = re.split(r"[*?\[{]", bare)[0]
    if fixed != bare:
        fixed = fixed.rpartition("/")[0]
    return os.path.abspath(fixed) if not fixed.startswith("/") else fixed.rstrip("/")


def _matches(paths: tuple[str, ...], contains: str) -> list[Column]:
    """For each path whether a file is below it and has ``contains`` in what the path adds; for a single file, in its name."""
    place = _place(F.col("_metadata.file_path"))
    found = []
    for root in map(_root, paths):
        below = F.startswith(place, F.lit(f"{root}/")) & F.contains(F.substr(place, F.lit(len(root) + 2)), F.lit(contains))
        found.append(below | ((place == root) & F.contains(F.substring_index(place, "/", -1), F.lit(contains))))
    return found


def header_manifest(spark: SparkSession, *paths: str, contains: str = "") -> DataFrame:
    """file, header of every matching run file, written as a table; an empty file has none and is left out.

    One distributed pass over the first split of each file; no list of files is
    made anywhere but in Spark's own listing.
    """
    missing = [F.max(match).alias(f"found{k}") for k, match in enumerate(_matches(paths, contains))]
    lines = spark.read.options(**LOOKUP).text(list(paths)).filter(F.col("_metadata.file_block_start") == 0)
    matching = reduce(lambda a, b: a | b, _matches(paths, contains))
    heads = (
        lines.filter(matching)
        .select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), "value")
        .groupBy("file").agg(F.min_by("value", "at").alias("header"))
    )
    listed = spark.read.options(**LOOKUP).format("binaryFile").load(list(paths)).select("path", "_metadata")  # contents are not read
    for path, found in zip(paths, listed.agg(*missing).first()):
        if not found:
            raise FileNotFoundError(f"no run file in {path!r} with {contains!r} in its name")
    table = f"{shared_folder(spark)}/run-headers-{uuid.uuid4().hex}"
    heads.write.parquet(table)
    return spark.read.parquet(table)


def read_runs(spark: SparkSession, *paths: str, contains: str = "") -> DataFrame:
    """Union of run files, typed by column name, in one scan.

    Each path is a directory, searched to the bottom, or one CSV file.  Only
    files with ``contains`` in their name, or in that of a folder below the
    path, count; no match raises.  Files may differ in their columns and in the
    order of them: cells are read by place and named by their own file's
    header.  Columns that a file does not have are NULL; columns that no schema
    knows are text and stand last.
    """
    heads = header_manifest(spark, *paths, contains=contains)
    # One row for each different header: a few, however many files there are.
    layouts = [r.header for r in heads.select("header").distinct().orderBy("header").collect()]
    if not layouts:
        return spark.createDataFrame([], RUN_SCHEMA)
    named = [[_cell(c) for c in row] for row in csv.reader(layouts, doublequote=True)]
    width = max(map(len, named))
    cells = StructType([StructField(f"_c{k}", StringType()) for k in range(width)])
    rows = spark.read.options(**CSV_OPTIONS).options(**LOOKUP).schema(cells).csv(list(paths))
    numbers = F.create_map(*(F.lit(x) for k, header in enumerate(layouts) for x in (header, k)))
    files = heads.select(F.col("file").alias("_file"), F.element_at(numbers, F.col("header")).alias("_layout"))
    if heads.count() <= FEW_FILES:
        files = F.broadcast(files)
    matching = reduce(lambda a, b: a | b, _matches(paths, contains))
    joined = rows.filter(matching).withColumn("_path", F.col("_metadata.file_path")).join(files, F.col("_path") == F.col("_file"))
    every = {name for header in named for name in header}
    order = [n for n in KNOWN if n in every] + sorted(every - set(KNOWN))
    cell = F.array(*(F.col(f"_c{k}") for k in range(width)))

    def column(name: str) -> Column:
        at = [header.index(name) if name in header else None for header in named]
        if len(set(at)) == 1:
            return _typed(name, F.col(f"_c{at[0]}"))
        place = F.get(F.array(*(F.lit(k).cast("int") for k in at)), F.col("_layout"))
        return _typed(name, F.get(cell, place))

    return joined.select(*map(column, order))


def _cell(name: str) -> str:
    return name.removeprefix("\ufeff")


def land_runs(runs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write runs as Parquet by method, seed and shard.

    Multi-line CSV cannot be split and carries every column; Parquet can be
    split and pruned.  The rebalance hint brings the rows of one directory
    together, so each gets few files, and splits those of a directory that
    holds a large share of all rows over many tasks.
    """
    present = [name for name in PARTITIONS if name in runs.columns]
    together = runs.hint("rebalance", *[F.col(name) for name in present])
    together.write.mode(mode).partitionBy(*present).parquet(path)


def read_landed(spark: SparkSession, path: str, schema: str = RUN_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_run_csv(runs: DataFrame, path: str, num_shards: int = 1) -> None:
    """CSV per run, in directories that carry the run's name."""
    named = runs.withColumn("run", run_name(num_shards))
    (
        named.write.mode("overwrite")
        .options(**WRITE_OPTIONS)
        .partitionBy("run")
        .csv(path)
    )


def csv_header(names: list[str]) -> str:
    """A header line as the CSV writer writes it."""
    return ",".join('"' + n.replace('"', '""') + '"' if re.search(r'[",\n\r]', n) else n for n in names)


def csv_line(names: list[str]) -> Column:
    """A row as the CSV writer writes it."""
    options = {k: str(v).lower() for k, v in WRITE_OPTIONS.items() if k != "header"}
    return F.to_csv(F.struct(*(F.col(f"`{n}`") for n in names)), options)


def write_run_files(runs: DataFrame, path: str, *order: str, num_shards: int = 1) -> None:
    """One CSV file for each run, ``{run name}.csv``, found again by its name; rows in the given order."""
    names = runs.columns
    lines = runs.select("*", F.concat(run_name(num_shards), F.lit(".csv")).alias("file"), csv_line(names).alias("line"))
    write_lines(lines, path, *order, header=csv_header(names))
