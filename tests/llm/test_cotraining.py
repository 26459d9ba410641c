import random

import numpy as np
import pytest

from kickflow.llm import cotraining
from kickflow.llm.cotraining import co_train, metadata_features, quality, text_features
from kickflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    found = QUERIES["op5_quality"](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality IS NOT NULL")
    rows = found.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    truth = np.array([r.quality for r in rows])
    predicted = np.array([r.predicted for r in rows])
    recall = [(predicted[truth == k] == k).mean() for k in (0, 1)]
    assert min(recall) > 0.85, recall
    assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_views_teach_each_other():
    """With few labels, a view that is weak alone gains from the other's pseudo-labels."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 4000)
    strong = (2 * y - 1)[:, None] * 1.5 + rng.normal(size=(4000, 1))
    weak = np.hstack([(2 * y - 1)[:, None] * 1.2 + rng.normal(size=(4000, 1)), rng.normal(size=(4000, 25))])
    few = slice(0, 30)
    test = slice(2000, 4000)
    pool = slice(30, 2000)
    accuracy = []
    for rounds in (0, 8):
        model = co_train(strong[few], weak[few], y[few].astype(float), strong[pool], weak[pool], rounds=rounds)
        _, _, score = model.score(strong[test], weak[test])
        accuracy.append(((score >= 0.5) == y[test]).mean())
    assert accuracy[1] > accuracy[0]


def test_odd_rows(spark, documents):
    random.seed(3)
    rows = [(i, "good words and more of them. " * random.randint(1, 9)) for i in range(40)]
    rows += [(i, "BAD!! " * random.randint(3, 30)) for i in range(40, 80)]
    rows += [(None, "x"), (90, None), (91, ""), (92, "word " * 100_000), (93, "x"), (93, "x")]
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(0, 80, 2)] + [(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    found = quality(documents(*rows), labels).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 for r in found)
    scores = {r.doc_id: r.score for r in found}
    assert min(scores[i] for i in range(40)) > max(scores[i] for i in range(40, 80))


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0), ([(1, 0), (1, 1)], 1.0)])
def test_labels_of_one_kind(spark, documents, labels, score):
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    found = quality(documents((1, "a"), (2, "b"), (3, None)), marks).collect()
    assert {r.score for r in found} == {score}


def test_empty_table(spark, documents):
    marks = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert quality(documents((1, "a")).where("false"), marks).count() == 0


def test_features_of_nothing():
    assert len(text_features(None)) == len(text_features("A b!")) == 20
    assert metadata_features([None, ""], None) != metadata_features(["", ""], 0)


def test_whole_pool_takes_part(spark, documents, monkeypatch):
    """More unlabelled rows than were once drawn: all of them are shown to the views."""
    seen = []
    whole = cotraining.co_train
    monkeypatch.setattr(cotraining, "co_train", lambda *a, **k: seen.append((k["n_pool"], k["total"](lambda x: [np.array(len(x[0]))]))) or whole(*a, **k, rounds=1))
    docs = spark.range(20_150).selectExpr("id AS doc_id", "if(id % 2 = 0, repeat('good words. ', 1 + id % 9), repeat('BAD!! ', 1 + id % 9)) AS text", "'en' AS lang", "'s' AS source", "id AS n_chars")
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(100)], "doc_id long, quality int")
    assert quality(docs, labels).count() == 20_150
    assert seen[0] == (20_050, [20_050])


def test_sums_of_many_tasks_are_merged(spark, monkeypatch):
    """However many tasks there are, the driver gets few sums, and the scores stay."""
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    few = {r.doc_id: r.score for r in quality(docs.coalesce(1), labels).collect()}
    monkeypatch.setattr(cotraining, "MERGED", 2)
    # A task for each file of the pool.
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = {r.doc_id: r.score for r in quality(docs.repartition(12), labels).collect()}
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert many.keys() == few.keys() and all(abs(many[i] - few[i]) < 1e-6 for i in few)
