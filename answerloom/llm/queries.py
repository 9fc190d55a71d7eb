"""The queries of this package, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.llm import (
    decontaminate, license_scan, merkle, mixing, quality_model, quality_rules, resample, secret_scan, sharding, simhash,
    suffix_dedup, token_blocks, warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_rows(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken", F.get("shards", F.lit(0)).alias("first_shard")
    )


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(_table(spark, sf_dir, "pages"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"), license_scan.default_templates(spark))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(_table(spark, sf_dir, "documents"))


def op12_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_blocks.digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operator 5 counts before any vote, for comparison with SQL."""
    return quality_rules.digest(_table(spark, sf_dir, "documents")).drop("kept")


def document_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operator 10 measures before any draw, for comparison with SQL."""
    return sharding.digest(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_mix_sources, op3_simhash_near_dedup, op4_secret_scan, op5_quality_rules, op6_warc,
        op7_suffix_dedup, op8_license_scan, op9_quality_classifier, op10_shard_tree, op11_merkle_manifest, op12_token_blocks,
        op13_importance_resample, quality_base_counts, document_sizes,
    )
}
