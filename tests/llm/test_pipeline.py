import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from answerloom.llm import quality_model, simhash
from answerloom.llm.oracles import ORACLES
from answerloom.llm.queries import QUERIES
from tests.llm import cases
from workload.check import connect, rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_stages_follow_one_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, names = docs.columns, []
    seen = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = f"{spark.conf.get('spark.sql.warehouse.dir')}/test-{os.getpid()}-{name}"
        out.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
        names.append(name)
        if name == "sharded":
            assert out.columns == [*columns, "shard"] and out.count() == docs.count()
            assert {r.shard for r in out.collect()} <= set(range(40))
        else:
            assert out.columns == columns and {tuple(r) for r in out.collect()} <= seen
            assert 0 < out.count() <= 2 * docs.count()
        docs = out
    assert names == ["quality", "near_duplicates", "decontaminated", "mixed", "sharded"]
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, docs.collect()))


NAMES = {"fp": "_score", "score": "weight", "votes": "_text_hash", "slot": "passes", "law": "row", "rank": "source_size", "bucket": "text_hash"}


def first_of_each_group(docs):
    """What the near-duplicate stage keeps, by comparing all fingerprints."""
    prints = [simhash.fingerprint_of(r.text) for r in docs]
    group = list(range(len(docs)))
    for _ in docs:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    group[i] = group[j] = min(group[i], group[j])
    kept = {}
    for r, g in zip(docs, group):
        key = (r.doc_id is None, r.doc_id or 0)
        if g not in kept or key < kept[g][0]:
            kept[g] = (key, r)
    return Counter((r.doc_id, r.text) for _, r in kept.values())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_documents_with_clashing_columns(spark, name, stage):
    docs = cases.documents(spark).withColumnsRenamed(NAMES)
    given = docs.collect()
    out = stage(spark, docs, SF)
    got = out.collect()
    if name == "sharded":
        assert out.columns == docs.columns and dict(out.dtypes)["shard"] == "int"  # the one it replaces
        assert Counter(str(r.asDict() | {"shard": 0}) for r in got) == Counter(str(r.asDict() | {"shard": 0}) for r in given)
        assert {r.shard for r in got} <= set(range(40))
        return
    assert out.schema == docs.schema
    left = Counter(map(str, got)) - Counter(map(str, given)) - Counter(map(str, given))
    assert not left and (name == "mixed" or not Counter(map(str, got)) - Counter(map(str, given)))
    if name == "near_duplicates":
        assert Counter((r.doc_id, r.text) for r in got) == first_of_each_group(given)
    if name == "mixed":
        assert not [r for r in got if not cases.words(r.text)]
    if name == "decontaminated":
        assert {r.doc_id for r in given if not r.text} <= {r.doc_id for r in got}


def test_quality_keeps_what_the_classifier_predicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    predicted = {r.doc_id for r in quality_model.classify(docs, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF).collect()} == predicted


def test_no_stage_minds_an_empty_predecessor(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    frame = QUERIES[name](spark, SF)
    result = connect(SF).execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows(frame.columns, frame.collect()) == rows(columns, result.fetchall())


def test_every_query_is_registered():
    import __spark_entry__ as driver

    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql()) and duckdb
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
