"""From raw documents to shards of training text, stage by stage.

A stage takes (spark, docs, sf_dir); ``docs`` has the columns of documents and
may have others, of any name.  All stages but the last return rows as they came,
columns and types included.  NULLs, empty and very long texts, ties, repeated
rows and empty tables have the results that the stage's docstring states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from answerloom.llm import decontaminate, mixing, quality_model, sharding, simhash
from answerloom.llm.common import land

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    It is fitted on ``docs`` and the labels.  NULL, empty and blank texts share
    one score; repeated rows weigh in each and stay or go together; texts of any
    length are read whole; equal scores have the same fate.  No documents, no
    rows; without trusted positives every score is 0.5 and nothing stays.
    """
    return quality_model.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest doc_id.

    Fingerprints of four-word shingles link at four differing bits or fewer.
    NULL, empty and blank texts have the fingerprint zero and are one group with
    what links to it.  Rows that agree in doc_id and text leave one row; where
    only the smallest doc_id repeats, a hash of the text decides.  A NULL doc_id
    stays only where its group has no other.  No documents, no rows.
    """
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a test of the benchmark go.

    NULL, empty and blank texts are clean; texts of any length are searched
    whole; repeated rows stay or go together; no documents, no rows.
    """
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes once for every pass of the mix that takes any of its words, so up to twice.

    NULL, empty and blank texts have no words to take and go.  NULL is a source,
    the last.  Repeated rows lie side by side in their source's line; ties there
    are broken by doc_id and size.  A long document is taken whole even if its
    source's budget ends within it.  No documents, no rows.
    """
    return mixing.take(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ``shard`` of 40, decided by doc_id alone; a column of that name is replaced.

    A NULL doc_id is a key like any other; equal ones share a shard, so repeated
    rows do.  Texts, NULL, empty or long, are not looked at.  No documents, no rows.
    """
    return sharding.place(docs, sharding.layout(40))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("sharded", sharded),
]
# A fitted classifier, fingerprints and tiles are beyond SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next one reads it."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
