"""Quality scores: accuracy on held-out rows, and FTRL against its formula."""

import math

import numpy as np

from lodeworks.llm.common import held_out
from lodeworks.llm.quality import features, ftrl, score, train


def test_held_out_accuracy(spark):
    root = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{root}/{name}.parquet") for name in ("documents", "labels"))
    model = train(docs, labels)
    rows = score(docs, model).join(labels, "doc_id").where(held_out(labels["doc_id"])).collect()
    assert len(rows) > 500
    assert sum((r.quality_score >= 0.3) != r.quality for r in rows) <= 0.03 * len(rows)


def test_leader_of_one_coordinate():
    rows = [(np.array([0, 4]), np.array([1.0, 1.0]), y) for y in (1, 0, 1, 1)]
    constant, weights = ftrl(rows, 2, 1, 0.5, 1.0, 0.0, 0.1)
    z = n = w = 0.0
    for y in (1, 0, 1, 1):
        w = -z / ((1.0 + math.sqrt(n)) / 0.5 + 0.1)
        g = 1 / (1 + math.exp(-2 * w)) - y
        z += g - (math.sqrt(n + g * g) - math.sqrt(n)) / 0.5 * w
        n += g * g
    w = -z / ((1.0 + math.sqrt(n)) / 0.5 + 0.1)
    assert math.isclose(weights[0], w)
    assert math.isclose(constant, w)
    assert not weights[1:].any()


def test_features_cover_the_whole_text():
    text = "one two " * 5000
    assert len(features(text, 18)) == 5 * 10_000 - 1 - 1 - 2
    assert len(features("", 18)) == len(features(None, 18)) == 0


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(k, k % 2) for k in range(9)] + [(None, 1), (3, None)], "doc_id long, quality int")
    for model in (train(odd_documents, labels), train(no_documents, labels), train(odd_documents, labels.limit(0))):
        rows = score(odd_documents, model).collect()
        assert len(rows) == odd_documents.count()
        assert all(0 <= r.quality_score <= 1 for r in rows)
        assert score(no_documents, model).collect() == []
    assert {r.quality_score for r in rows} == {0.5}
