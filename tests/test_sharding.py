import json

import pytest

from pyspark.sql import functions as F

from answerloom.operators.sharding import natural, take_shard, with_file_position, with_position
from answerloom.plans.prepare import prompts_for_shard
from answerloom.sources.problems import read_problems, read_problems_in_order


def test_positions_are_dense_and_ordered(spark):
    keys = [(i * 7919) % 1000 for i in range(1000)]
    df = spark.createDataFrame([(f"k{k:04d}", "x" * (k % 5)) for k in keys], "key STRING, v STRING")
    rows = with_position(df.repartition(7), "key").collect()
    assert sorted((r.position, r.key) for r in rows) == [(i, f"k{i:04d}") for i in range(1000)]
    assert rows[0].__fields__ == ["key", "v", "position"]


def test_file_positions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(path)
    rows = with_file_position(spark, path).collect()
    assert sorted((r.position, r.id) for r in rows) == [(i, i) for i in range(1000)]
    plan = with_file_position(spark, path)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_shards_partition_the_rows(spark):
    df = spark.range(103).withColumnRenamed("id", "position")
    shards = [[r.position for r in take_shard(df, s, 4).collect()] for s in range(4)]
    assert [len(s) for s in shards] == [26, 26, 26, 25]
    assert sorted(p for s in shards for p in s) == list(range(103))
    assert sorted(r.position for r in take_shard(df, 3, 4, 2).collect()) == [3, 7]
    assert take_shard(df, 0, 1, 0).count() == 103
    with pytest.raises(ValueError):
        take_shard(df, 4, 4)


def test_numbers_in_file_names_count_as_numbers(one_column):
    names = ["part-100000-a.parquet", "part-99999-z.parquet", "part-00001-c1000", "part-00001-c999"]
    keys = dict(zip(one_column(natural, names), names))
    assert [keys[k] for k in sorted(keys)] == [names[3], names[2], names[1], names[0]]


def test_file_order_beyond_a_hundred_thousand_parts(spark, tmp_path):
    folder = tmp_path / "t"
    for number, start in ((99999, 0), (100000, 10), (100001, 20)):
        spark.range(start, start + 10).coalesce(1).write.parquet(str(tmp_path / str(number)))
        source = next((tmp_path / str(number)).glob("part-*.parquet"))
        folder.mkdir(exist_ok=True)
        (folder / f"part-{number}-x.parquet").write_bytes(source.read_bytes())
    rows = with_file_position(spark, str(folder)).collect()
    assert sorted((r.position, r.id) for r in rows) == [(i, i) for i in range(30)]


def test_positions_of_repeated_keys_are_dense(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), "id").repartition(5)
    rows = with_position(df, "k", "id").collect()
    assert [r.id for r in sorted(rows, key=lambda r: r.position)] == [i for k in range(3) for i in range(k, 500, 3)]


def test_problem_shards_follow_the_file(spark, tmp_path):
    ids = ["z", "a", None, "m", "", "a", None, "b"]
    lines = [{"problem": f"p{k}", "answer": str(k)} | ({} if i is None else {"unique_id": i}) for k, i in enumerate(ids)]
    (tmp_path / "p.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))
    problems = read_problems_in_order(spark, str(tmp_path))
    for shard in range(3):
        got = sorted(prompts_for_shard(problems, shard, 3).collect(), key=lambda r: r.position)
        assert [r.gold for r in got] == [str(k) for k in range(shard, len(ids), 3)]
    unordered = [r for s in range(3) for r in prompts_for_shard(read_problems(spark, str(tmp_path)), s, 3).collect()]
    assert sorted(r.position for r in unordered) == list(range(len(ids)))
    assert [r.example_id for r in sorted(unordered, key=lambda r: r.position)] == sorted(i or "" for i in ids)


@pytest.mark.parametrize("range_rows, most", [(1000, 64), (7, 4096), (1, 50), (10**6, 2)])
def test_positions_over_many_ranges(spark, range_rows, most):
    """Two key columns with NULLs and text; the numbers do not depend on the ranges, nor is anything written."""
    rows = [(None if k % 11 == 0 else f"é{k % 23}", k if k % 5 else None, k) for k in range(700)]
    df = spark.createDataFrame(rows, "a string, b long, id long").repartition(6)
    placed = with_position(df, "a", "b", "id", range_rows=range_rows, most_ranges=most)
    want = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    assert [(r.a, r.b, r.id) for r in sorted(placed.collect(), key=lambda r: r.position)] == want
    assert sorted(r.position for r in placed.collect()) == list(range(700))
    assert "parquet" not in placed._jdf.queryExecution().toString().lower()


def test_positions_of_an_empty_table(spark):
    assert with_position(spark.range(0), "id").collect() == []
