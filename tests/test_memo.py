"""Grades kept between runs."""

import os
import random

from pyspark.sql import functions as F

from answerloom.operators import memo
from answerloom.operators.grading import grade_runs


def runs(spark, n, seed):
    pick = random.Random(seed)
    rows = [
        (k, None if k % 17 == 0 else f"so \\boxed{{{pick.randrange(30)}}}", None if k % 13 == 0 else str(pick.randrange(30)))
        for k in range(n)
    ]
    return spark.createDataFrame(rows, "id int, completion string, gold string").repartition(3)


def grades(df):
    return sorted((r.id, r.pred_eval, r.correct_eval) for r in df.collect())


def test_only_new_pairs_are_graded(spark, tmp_path):
    path = str(tmp_path / "memo")
    first, second = runs(spark, 300, 1), runs(spark, 500, 2)
    assert grades(memo.grade_runs_with_memo(first, path, "a")) == grades(grade_runs(first))
    known = memo.read_memo(spark, path).count()
    assert grades(memo.grade_runs_with_memo(second, path, "b")) == grades(grade_runs(second))
    pairs = memo.read_memo(spark, path)
    assert pairs.count() > known and pairs.count() == pairs.distinct().count()
    # A third evaluation of either finds everything.
    again = memo._distinct_pairs(memo.extract_answers(first.unionByName(second)), "pred_eval", "gold")
    assert memo.new_pairs(again, path).count() == 0
    assert memo.remember(again, path, "c") == 0
    assert grades(memo.grade_runs_with_memo(second, path, "d")) == grades(grade_runs(second))
    assert memo.read_memo(spark, path).count() == pairs.count()


def test_a_repeated_job_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "memo")
    table = runs(spark, 100, 3)
    memo.grade_runs_with_memo(table, path, "a")
    rows = sorted(map(str, memo.read_memo(spark, path).collect()))
    memo.grade_runs_with_memo(table, path, "a")
    assert sorted(map(str, memo.read_memo(spark, path).collect())) == rows
    # Half of it is lost: the next run adds that half again.
    part = next(f for f in sorted(os.listdir(f"{path}/batch=a")) if f.endswith(".parquet") and os.path.getsize(f"{path}/batch=a/{f}") > 1000)
    os.rename(f"{path}/batch=a/{part}", tmp_path / "lost.parquet")
    memo.grade_runs_with_memo(table, path, "a")
    assert sorted(map(str, memo.read_memo(spark, path).collect())) == rows


def test_what_a_lost_job_leaves_is_not_read(spark, tmp_path):
    path = str(tmp_path / "memo")
    table = runs(spark, 100, 3)
    memo.grade_runs_with_memo(table, path, "a")
    count = memo.read_memo(spark, path).count()
    left = tmp_path / "memo" / "batch=b" / "_temporary" / "0"
    left.mkdir(parents=True)
    (left / "part-0.parquet").write_bytes(b"half")
    assert memo.read_memo(spark, path).count() == count


def test_filter_keeps_every_key(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    others = spark.range(10**6, 10**6 + 5000).select(F.xxhash64("id").alias("key"))
    marked = memo.key_filter(keys, 1 << 20)
    assert marked.count() <= (1 << 20) // 32768
    assert memo.maybe_in(keys, marked, 1 << 20).count() == 5000
    assert memo.maybe_in(others, marked, 1 << 20).count() < 100


def test_answers_are_extracted_once_for_the_pairs_and_once_for_the_result(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    table = runs(spark, 200, 5).withColumn("completion", counted.asNondeterministic()("completion"))
    graded = memo.grade_runs_with_memo(table, str(tmp_path / "memo"), "a")
    assert graded.count() == 200 and grades(graded) == grades(grade_runs(runs(spark, 200, 5)))
    assert seen.value <= 600  # the pairs, the count and the grades
