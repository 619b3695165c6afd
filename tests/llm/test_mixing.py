"""Poisson replication against its definition."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodeworks.llm.mixing import mix


def copies(mean, doc_id, seed=17):
    u = (int(hashlib.md5(f"{seed}:1:{doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    k, p = 0, math.exp(-mean)
    c = p
    while c < u:
        k += 1
        p *= mean / k
        c += p
    return k


def test_copies_and_order(documents):
    weights = {"src0": 3.0, "src1": 1.0, "gone": 5.0}
    rows = mix(documents, weights, total=1200).collect()
    sizes = Counter(r.source for r in documents.collect())
    expected = Counter()
    for r in documents.collect():
        if r.source in ("src0", "src1"):
            share = weights[r.source] / 4
            expected[r.doc_id] = copies(share * 1200 / sizes[r.source], r.doc_id)
    assert Counter(r.doc_id for r in rows) == +expected
    assert 1000 < len(rows) < 1400


def test_mean_rate_beyond_one_draw(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    n = mix(docs, {"a": 1.0}, total=50 * 1300).count()
    assert abs(n - 65_000) < 5 * math.sqrt(65_000)


def test_whole_order_does_not_follow_the_input(documents):
    keys = [r.mix_key for r in mix(documents).collect()]
    assert len(set(keys)) == len(keys)


def test_same_rows_each_time(documents):
    assert sorted(r.mix_key for r in mix(documents).collect()) == sorted(r.mix_key for r in mix(documents.repartition(7)).collect())


def test_odd_rows(odd_documents, no_documents):
    clash = odd_documents.withColumn("mix_key", F.lit("old")).withColumn("copies", F.lit(9)).withColumn("rate", F.lit(1))
    found = mix(clash, total=200)
    assert set(found.columns) == set(clash.columns) | {"mix_copy", "mix_rate", "mix_key"}
    rows = found.collect()
    assert {r.source for r in rows} == {None, "s", "t"}
    assert "old" not in {r.mix_key for r in rows}
    twice = Counter(r.length for r in rows)
    assert twice[7] == twice[8]
    assert mix(no_documents).collect() == []


@pytest.mark.parametrize("weights", [{None: 1.0}, {"s": 0.0, "t": 2.0}])
def test_weights_by_name(odd_documents, weights):
    left = {r.source for r in mix(odd_documents, weights, total=100).collect()}
    assert left == {name for name, weight in weights.items() if weight}


def test_plan_has_no_python(documents):
    plan = mix(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan
    assert "Arrow" not in plan
