import zlib
from collections import Counter

from pyspark.sql import functions as F

from answerloom.llm import sharding
from tests.llm import cases


def test_digest(spark):
    got = sharding.shard_digest(cases.documents(spark)).collect()
    want = Counter(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in cases.rows()
    )
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    assert {r.law for r in got} == {"key"}
    assert all(r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40 for r in got)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    again = sharding.shard_digest(cases.documents(spark).repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_growth_moves_rows_only_into_the_new_shard(spark):
    ids = spark.range(20000).withColumnRenamed("id", "doc_id")
    df = ids
    for n in (40, 41, 42, 45):
        df = sharding.place(df, sharding.layout(n), f"s{n}")
    counts = df.groupBy("s40", "s41", "s42", "s45").count().collect()
    for r in counts:
        assert r.s41 in (r.s40, 40) and r.s42 in (r.s41, 41) and (r.s45 == r.s42 or r.s45 >= 42)
    sizes = Counter()
    for r in counts:
        sizes[r.s40] += r["count"]
    assert set(sizes) == set(range(40)) and all(400 < n < 600 for n in sizes.values())


def test_a_change_of_weight_stays_in_its_subtree(spark):
    def tree(weight):
        racks = [sharding.inner(f"r{k}", [sharding.leaf(3 * k + j, weight if (k, j) == (0, 0) else 1.0) for j in range(3)])
                 for k in range(4)]
        return sharding.inner("root", [sharding.inner("a", racks[:2]), sharding.inner("b", racks[2:])])

    df = spark.range(20000).withColumnRenamed("id", "doc_id")
    df = sharding.place(sharding.place(df, tree(1.0), "old"), tree(2.0), "new")
    moved = df.filter("old <> new").groupBy("old", "new").count().collect()
    # The path to the heavier shard gains; rows that never touch its region stay where they are.
    assert moved and all(r.new < 6 for r in moved)
    assert df.filter("old >= 6 and new >= 6 and old <> new").isEmpty()
    share = df.filter("new = 0").count() / 20000
    assert abs(share - 2 / 13) < 0.02
    assert sharding.place(df, tree(0.0), "none").filter("none = 0").isEmpty()


def test_draws_follow_the_key_alone(spark):
    df = spark.createDataFrame([(5, "x"), (5, "y"), (None, "z"), (None, "z")], "doc_id long, shard string")
    got = sharding.place(df, sharding.layout(40)).collect()
    assert got[0].shard == got[1].shard and got[2].shard == got[3].shard is not None
    assert sharding.shard_digest(cases.empty(spark)).collect() == []


def test_many_rows_of_one_key_get_their_own_slots(spark):
    df = sharding.place(spark.range(3000).select(F.lit(1).alias("doc_id"), "id"), sharding.layout(40))
    slots = [r.slot for r in sharding.with_slots(df, ["doc_id"]).collect()]
    assert sorted(slots) == list(range(3000))
