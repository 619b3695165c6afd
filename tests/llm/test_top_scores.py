"""Top scores against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeworks.llm.top_scores import top_scores


def brute_force(rows, k, asks):
    good = {(i, tuple(math.floor(64 * float(x)) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i in sorted({i for i, _ in good if asks(i)}):
        own = [v for j, v in good if j == i]
        scores = sorted((-sum(a * b for a, b in zip(u, v, strict=True)), j) for u in own for j, v in good if j != i and len(v) == len(u))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return out


@pytest.mark.parametrize(("lists", "query_rows", "block_rows"), [(2, 512, 4096), (4, 7, 40), (3, 1, 1000)])
def test_all_embeddings(spark, sf, lists, query_rows, block_rows):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    found = top_scores(vectors, F.col("vec_id") % 20 == 0, 20, 64.0, lists, query_rows, block_rows)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, 20, lambda i: i % 20 == 0)


def test_ties_copies_and_few_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [0.5, 0.25, -0.75]) for k in range(60)] + [(100 + k, rng.normal(size=3).tolist()) for k in range(30)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, top_scores(vectors, F.col("vec_id") % 20 == 0, 5, block_rows=16).collect()))
    assert found == brute_force(rows, 5, lambda i: i % 20 == 0)
    few = vectors.where("vec_id > 125 OR vec_id = 120")
    found = sorted(map(tuple, top_scores(few, F.col("vec_id") % 20 == 0, 20).collect()))
    assert found == brute_force([r for r in rows if r[0] > 125 or r[0] == 120], 20, lambda i: i % 20 == 0)
    assert len(found) == few.count() - 1


def test_odd_rows(spark):
    nan = float("nan")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [0.0, 0.0]), (6, [3.0, -1.0]), (6, [3.0, -1.0]),
        (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [1e9, 1.0]), (40, [-1e9, 2.0]),
    ]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, node string")
    found = sorted(map(tuple, top_scores(vectors, F.col("vec_id") % 20 == 0, 3).collect()))
    assert found == brute_force(rows, 3, lambda i: i % 20 == 0)
    assert top_scores(vectors.limit(0), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("size", [1.0, 1e6])
def test_ids_with_many_vectors_and_large_components(spark, size):
    rng = np.random.default_rng(4)
    rows = [(k, (size * rng.normal(size=4)).tolist()) for k in range(120)]
    for i, n in ((1, 2), (3, 30), (20, 2), (40, 30)):
        near = np.asarray(rows[20 if i == 40 else 40][1])
        rows += [(i, (near * rng.uniform(0.9, 3)).tolist()) for _ in range(n - 1)]
    rows += [(k, rows[60][1]) for k in (200, 201, 220)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, top_scores(vectors, F.col("vec_id") % 20 == 0, 5, block_rows=50, query_rows=4).collect()))
    assert found == brute_force(rows, 5, lambda i: i % 20 == 0)


def test_ids_of_the_verdict(spark):
    rows = [(1, [1.0, 2.0]), (1, [2.0, 2.0]), (20, [1.0, 1.0]), (3, [0.5, 0.5]), (4, [600_000.0, 1.0]), (5, [700_000.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, top_scores(vectors, F.col("vec_id") % 20 == 0, 3).collect()))
    assert found == brute_force(rows, 3, lambda i: i % 20 == 0)
    assert [r[2] for r in found] == [5, 4, 1]
