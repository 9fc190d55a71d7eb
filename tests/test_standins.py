"""Tables are spread over tasks, whatever their files look like."""

from pyspark.sql import functions as F

from workload import standins


def test_a_file_of_one_row_group_is_spread_though_it_has_many_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(standins, "ROWS_A_TASK", 500)
    spark.range(10_000).withColumn("t", F.sha2(F.col("id").cast("string"), 256)).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        assert spark.read.parquet(f"{tmp_path}/orders.parquet").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        table = standins.table(spark, str(tmp_path), "orders")
        sizes = [r["count"] for r in table.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(sizes) == 10_000 and max(sizes) < 1000
