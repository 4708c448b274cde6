"""The compression classifier: held-out accuracy on the given labels, whole texts, the edge cases."""

import numpy as np
import pytest

from assayspark.llm import compression_classifier as cc, queries


def test_held_out_accuracy(spark):
    scored = queries.QUERIES["op1_compression_classifier"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    rows = scored[scored.held_out].merge(labels, on="doc_id")
    good, bad = rows[rows.quality == 1].score, rows[rows.quality == 0].score
    assert np.mean([(good > b).mean() + (good == b).mean() / 2 for b in bad]) > 0.95
    assert (rows.predicted == rows.quality).mean() > 0.93
    assert len(scored) == 1000 and scored.score.between(0, 1).all()


def test_one_label_none_and_odd_texts(spark):
    docs = spark.createDataFrame([(1, "a b", 0.1), (2, None, 0.1), (2, "", None), (None, "x" * 100_000, 0.2)], "doc_id long, text string, label double")
    for labels, want in (([], 0.5), ([(1, 1, 0)], 0.999), ([(1, 0, 0)], 0.001)):
        model = cc.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, id int"))
        got = cc.score(docs, model).collect()
        assert [r["score"] for r in got] == [pytest.approx(want)] * 4 and got[0].__fields__ == ["doc_id", "text", "label", "score"]
    both = cc.fit(docs, spark.createDataFrame([(1, 1), (2, 0), (None, 1), (9, 0)], "doc_id long, quality int"))
    got = cc.score(docs, both).collect()
    assert all(0 <= r["score"] <= 1 for r in got)
    assert cc.score(docs.limit(0), both).collect() == []


def test_every_block_counts():
    sizes = cc.Sizes(b"good words " * 50, b"bad!! #### " * 50, True, cc.Settings(block=64))
    text = b"good words " * 30
    assert sizes.features(memoryview(text))[0] > 0 > sizes.features(memoryview(b"bad!! #### " * 30))[0]
    assert sizes.features(memoryview(text + b"bad!! #### " * 90))[0] < sizes.features(memoryview(text))[0]


def test_a_labelled_id_on_many_rows_is_one_example(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("1L as doc_id", "concat('hot ', id) as text").unionByName(spark.createDataFrame([(2, "b"), (3, "c")], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(cc, "sorted", lambda rows, key: seen.append(len(rows)) or sorted(rows, key=key), raising=False)
    first = cc.fit(docs.repartition(7), labels)
    again = cc.fit(docs.repartition(2), labels)
    assert seen == [3, 3] and (first.intercept, first.slopes) == (again.intercept, again.slopes)
