import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.llm import quality_model as model
from tests.llm import cases

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01").replace("sf0.001", "sf0.01")


def made(spark):
    """Prose is good and shouting is bad; a third of the documents is labelled."""
    good = [(k, ". ".join(cases.prose(9, 50 * k + j) for j in range(12))) for k in range(160)]
    bad = [(1000 + k, " ".join(w.upper() + "!!" for w in cases.prose(100, k).split())) for k in range(40)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string").repartition(4)
    labels = [(k, int(k < 1000), 0) for k, _ in good + bad if k % 3 == 0]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_scores_and_predictions(spark):
    docs, labels = made(spark)
    got = model.classify(docs, labels).collect()
    assert len(got) == 200
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    assert np.mean([r.predicted == int(r.doc_id < 1000) for r in got]) > 0.97


def test_held_out_and_negative_labels_are_not_learned(spark):
    docs, labels = made(spark)
    changed = labels.withColumn("quality", F.when(model.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    fewer = labels.filter("quality = 1")
    want = {r.doc_id: r.score for r in model.classify(docs, labels).collect()}
    for other in (changed, fewer):
        got = {r.doc_id: r.score for r in model.classify(docs, other).collect()}
        assert got == pytest.approx(want, abs=1e-9)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_held_out_accuracy(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    scored = model.classify(read("documents").repartition(8), read("labels")).filter("held_out")
    rows = scored.join(read("labels"), "doc_id").select("score", "predicted", "quality").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_non_negative_risk_beats_its_start():
    """Few positives beside many features: the unbiased risk goes below zero, the corrected one must not be worse."""
    rng = np.random.default_rng(3)
    width = 1 + len(model.FEATURES) * model.KNOTS
    x_u = np.c_[np.ones(4000), rng.normal(size=(4000, width - 1))]
    x_p = np.c_[np.ones(10), rng.normal(size=(10, width - 1)) + 0.5]
    m = model.Moments(4000, 10, x_u.mean(0), x_p.mean(0), x_u.T @ x_u / 4000, x_p.T @ x_p / 10)

    def risk(w):
        loss = lambda x, y: np.mean((1 - y * (x @ w)) ** 2) / 4
        return 0.6 * loss(x_p, 1) + max(0, loss(x_u, -1) - 0.6 * loss(x_p, -1)) + 1e-4 * w[1:] @ w[1:]

    plain = np.linalg.solve(m.square_u / 2 + 2e-4 * np.eye(width), 0.6 * m.mean_p - m.mean_u / 2)
    assert risk(model.fit(m, 0.6, ridge=1e-4)) <= risk(plain) + 1e-6


def test_odd_documents(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 1), (999, 1), (7, 1), (9, 1)], "doc_id long, quality int")
    got = model.classify(docs, labels).collect()
    assert len(got) == len(cases.rows())
    assert len({r.score for r in got if r.doc_id in (4, 5, 6)}) == 1
    kept = model.keep_good(docs, labels, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == len(cases.rows())
    assert {r.score for r in kept.collect()} == {0.5} and {r.features for r in kept.collect()} == {"mine"}
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in model.classify(docs, none).collect()} == {0.5}
    assert model.classify(cases.empty(spark), labels).collect() == []
