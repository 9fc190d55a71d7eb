"""Run queries against their oracles: ``python -m workload.check [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from workload.oracles import ORACLES
from workload.queries import QUERIES

NAMES = ("region nation customer supplier part orders lineitem events documents "
         "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dict):
        return tuple(sorted(value.items()))
    return value


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in data)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """'' when rows, columns and types agree, else what differs."""
    start = time.time()
    frame = QUERIES[name](spark, sf_dir)
    got = rows(frame.columns, frame.collect())
    took = time.time() - start
    print(f"{name}: {sum(got.values())} rows, {took:.1f} s", flush=True)
    if name not in ORACLES:
        return ""
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = rows(columns, result.fetchall())
    types = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN",
    }
    ours = {n: types.get(t, t) for n, t in frame.dtypes}
    theirs = {d[0]: str(d[1]) for d in result.description}
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} vs {sorted(theirs)}"
    if got != want:
        return f"values: only ours {list((got - want).items())[:3]}, only theirs {list((want - got).items())[:3]}"
    if ours != theirs:
        return f"types {ours} vs {theirs}"
    return ""


def main() -> int:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        if problem:
            failed += 1
            print(f"  FAIL {name}: {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
