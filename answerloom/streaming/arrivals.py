"""The merge and accuracy jobs over a directory that is still being filled.

Sampler processes finish one by one, each adding a run file.  Grading is
row-local, so it works on a stream unchanged, and so does
:func:`answerloom.operators.metrics.accuracy_by`, whose state is one pair of
counters per key whatever the number of rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from answerloom.operators.grading import grade_runs
from answerloom.sources.runs import CSV_OPTIONS, PARTITIONS, _typed, name_filter
from answerloom.sources.schemas import RUN_SCHEMA

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

# A run file has at most so many columns.
WIDEST = 64


def _named(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Cells by place -> columns by name.  A file comes in one piece, and its first row is its header."""
    file, places = None, {}
    for batch in batches:
        files = batch.column("file")
        changes = [k for k in range(batch.num_rows) if files[k].as_py() != (files[k - 1].as_py() if k else file)]
        bounds = sorted({0, *changes, batch.num_rows})
        for start, stop in zip(bounds, bounds[1:]):
            part = batch.slice(start, stop - start)
            if start in changes:
                file = files[start].as_py()
                header = [part.column(k)[0].as_py() for k in range(part.num_columns - 1)]
                places = {name.removeprefix("\ufeff"): k for k, name in reversed(list(enumerate(header))) if name}
                part = part.slice(1)
            if part.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [part.column(places[n]) if n in places else pa.nulls(part.num_rows, pa.string()) for n in names], names
                )


def arriving_runs(spark: SparkSession, path: str, contains: str = "", extra: Sequence[str] = ()) -> DataFrame:
    """Stream of run rows, each file read by its own header.

    Files may have the run columns in any order, and lack some, which are NULL
    then; ``extra`` names further text columns to take along.
    """
    kinds = [part.split() for part in RUN_SCHEMA.split(",")]
    names = [k[0] for k in kinds] + list(extra)
    cells = ", ".join(f"_c{k} STRING" for k in range(WIDEST))
    raw = (
        spark.readStream.schema(cells)
        .options(**CSV_OPTIONS | {"header": False})
        .option("pathGlobFilter", name_filter(contains))
        .csv(path)
    )
    rows = raw.select("*", F.col("_metadata.file_path").alias("file"))
    by_name = rows.mapInArrow(lambda batches: _named(batches, names), ", ".join(f"`{n}` STRING" for n in names))
    return by_name.select(*(_typed(n, F.col(f"`{n}`")) for n in names))


def land_arrivals(runs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Grade what has arrived, append it as Parquet, then stop.

    Each file is taken exactly once across restarts with the same checkpoint.
    """
    return (
        grade_runs(runs)
        .writeStream.format("parquet")
        .partitionBy(*PARTITIONS)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
