"""Whitened embeddings against integers of any size and numpy."""

import math

import numpy as np
import pytest

from lodeworks.llm.queries import op13_embedding_whitening
from lodeworks.llm.whitening import cross_products, fit, whiten

SCHEMA = "vec_id long, embedding array<double>"


def brute_force(rows):
    """Per fit list: n, sums, covariance in exact integers over n squared, and each row's integers."""
    lists = {}
    for key, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            lists.setdefault(len(v), []).append((key, [math.floor(1024 * c) + 100_000 for c in v]))
    out = {}
    for dims, members in lists.items():
        n = len(members)
        sums = [sum(x[i] for _, x in members) for i in range(dims)]
        v = [[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for _, x in members) / n**3 for j in range(dims)] for i in range(dims)]
        out[dims] = n, sums, np.array(v), members
    return out


def check(found, rows, components=8):
    expected = brute_force(rows)
    got = {}
    for r in found:
        got.setdefault(r.vec_id, []).append(r)
    assert sum(len(m) * min(components, d) for d, (_, _, _, m) in expected.items()) == len(found)
    for dims, (n, sums, v, members) in expected.items():
        e = np.linalg.eigvalsh(v)[::-1]
        k = min(components, dims)
        w = np.empty((n, k))
        for at, (key, x) in enumerate(members):
            own = sorted((r for r in got[key] if r.n == n), key=lambda r: r.component)
            assert [r.component for r in own[:: max(1, len(own) // k)]] == list(range(1, k + 1))
            assert {r.deviation for r in own} >= {sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))}
            w[at] = [r.whitened if r.whitened is not None else np.nan for r in own[:k]]
            assert [r.explained for r in own[:k]] == pytest.approx(list(e[:k] / np.trace(v)) if np.trace(v) else [0.0] * k, rel=1e-6, abs=1e-9)
        y = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for _, x in members])
        full = [c for c in range(k) if e[c] > 1e-12 * np.trace(v)]
        assert np.isnan(w).all(axis=0).sum() == k - len(full)
        if full:
            # Axes of the data: y = w * sqrt(e) * component, so the components follow from y and w.
            axes = np.linalg.lstsq(w[:, full] * np.sqrt(e[full]), y, rcond=None)[0] if len(full) == dims else None
            if axes is not None:
                assert np.abs(axes @ axes.T - np.eye(dims)).max() < 1e-6
                assert np.abs(v @ axes.T - axes.T * e[full]).max() < 1e-6 * e[0]
            covariance = np.cov(w[:, full].T, bias=True).reshape(len(full), -1)
            measured = np.abs(covariance - np.eye(len(full))).max()
            error = {r.identity_error for r in found if r.n == n}
            assert max(error) < 1e-4 and abs(max(error) - measured) < 1e-9


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for low, high in ((0, 1), (-5, 900), (-(2**62), 2**62 + 100_000)):
        x = rng.integers(low, high, (131, 5), endpoint=True)
        whole = x.astype(object)
        assert (cross_products(x) == whole.T @ whole).all()


def test_all_embeddings(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in vectors.collect()]
    found = op13_embedding_whitening(spark, sf)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = found.collect()
    check(found, rows)
    (n, sums, v, members), = brute_force(rows).values()
    e, axes = np.linalg.eigh(v)
    y = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for _, x in members])
    for c in range(8):
        w = np.array([r.whitened for r in sorted((r for r in found if r.component == c + 1), key=lambda r: r.vec_id)])
        expected = y[np.argsort([k for k, _ in members])] @ axes[:, -1 - c] / math.sqrt(e[-1 - c])
        assert min(np.abs(w - expected).max(), np.abs(w + expected).max()) < 1e-8


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=3).tolist()) for k in range(40)]
    rows += [(40, None), (41, []), (42, [1.0, None, 2.0]), (43, [1.0, math.nan, 2.0]), (44, [math.inf, 0.0, 0.0])]
    rows += [(100 + k, [0.5, float(k), 7.0, 7.0]) for k in range(5)]  # two dimensions do not vary
    rows += [(200, [0.25, 0.5])]  # alone of its length
    frame = spark.createDataFrame([(*r, k, "x") for k, r in enumerate(rows)], SCHEMA + ", n long, dims string").repartition(3)
    check(whiten(frame).collect(), rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, [1.0, 0.0])] * 3 + [(1, [0.0, 2.0]), (None, [0.5, 0.5]), (2**60 + 1, [0.25, 1.0])]
    found = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 12
    assert {r.n for r in found} == {6}
    assert {r.vec_id for r in found} == {1, None, 2**60 + 1}
    assert found[0].identity_error < 1e-9


def test_large_entries(spark):
    """Deviations beyond a long are null; projections stay right."""
    rows = [(k, [1e12 * k, float(k % 3)]) for k in range(7)] + [(9, [1e300, -1e300])]
    found = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 16
    assert {r.deviation for r in found} == {None}
    assert found[0].identity_error < 1e-6


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fit(empty) == {}
    assert whiten(empty).collect() == []
