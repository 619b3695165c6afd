"""Links and components of vectors against all pairs."""

import math

import numpy as np
import pytest

from lodeworks.llm.vector_links import link_vectors


def brute_force(rows, threshold):
    def usable(r):
        v = r[1]
        return bool(v) and r[0] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [r for r in rows if usable(r)]
    parent = {r[0]: r[0] for r in good}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {id(r): 0 for r in rows}
    for n, a in enumerate(good):
        x = np.array(a[1], float)
        for b in good[:n]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                y = np.array(b[1], float)
                if (x / np.linalg.norm(x)) @ (y / np.linalg.norm(y)) >= threshold:
                    links[id(a)] += 1
                    links[id(b)] += 1
                    lo, hi = sorted((find(a[0]), find(b[0])))
                    parent[hi] = lo
    return sorted(
        ((r[0], links[id(r)], find(r[0]), find(r[0]) == r[0]) if id(r) in map(id, good) else (r[0], 0, r[0], True) for r in rows),
        key=repr,
    )


def test_all_embeddings(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    assert sorted(map(tuple, link_vectors(vectors).collect()), key=repr) == brute_force(rows, 0.93)


@pytest.mark.parametrize(("cell_rows", "block_rows"), [(20, 8), (50, 1000)])
def test_many_cells_and_blocks(spark, cell_rows, block_rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6))
    rows = []
    for k in range(300):
        v = centres[k % 12] + rng.normal(size=6) * (0.02 if k % 3 else 0.5)
        rows.append((k, [float(np.float32(x)) for x in v], k % 2))
    rows += [(300 + k, rows[7][1], rows[7][2]) for k in range(40)]  # copies
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = link_vectors(vectors, 0.93, cell_rows, block_rows).collect()
    assert sorted(map(tuple, found), key=repr) == brute_force(rows, 0.93)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
        (7, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (9, [1.0, 0.0], 1), (10, [2.0, 0.0], 1), (10, [2.0, 0.0], 1),
        (11, [1.0, 0.0], 2), (12, [1.0, 0.0, 0.0], 1), (13, [1e-30, 0.0], 1), (14, [3e38, 0.0], 1),
    ]
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, node int, cell string")
    assert sorted(map(tuple, link_vectors(vectors).collect()), key=repr) == brute_force(rows, 0.93)
    assert link_vectors(vectors.limit(0)).collect() == []


def test_ids_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [5.0, 0.0], 2), (1, [5.0, 0.1], 2)]
    found = link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(map(tuple, found)) == [(1, 0, 1, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]


def test_very_small_and_large_components(spark):
    rows = [(k, [x * scale for x in v], 1) for scale in (1e-200, 1e200) for k, v in enumerate(([0.93, (1 - 0.93**2) ** 0.5], [1.0, 0.0]), int(scale > 1) * 2)]
    found = link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id for r in found} == {0, 1, 2, 3}
    assert all(r.n_links >= 1 for r in found)
