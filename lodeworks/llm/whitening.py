"""Whitening of embeddings by the principal components of their exact integer scatter.

Method. Every component c of a vector becomes the integer x = floor(1024 * c) + 100000. In each block of rows
the integers of a dimension are shifted to start at zero and cut into bit planes; the bits of a plane, one a
row, are packed into 64-bit words. The product sum of two dimensions is then the sum of popcount(plane AND
plane) over all pairs of planes, weighted by their powers of two: an exact integer. Shifts are undone and the
sums of all blocks added as integers. The scatter is centred as integers too, n * sum(xy) - sum(x) * sum(y),
and only the finished covariance is rounded to doubles, once an entry, before the eigenvectors are taken.

Scale. The first pass keeps one matrix a task, whatever the number of rows, and hands on its entries in pieces
of 40 bits, which Spark adds up as longs. The matrix of all rows, of the square of the dimension, reaches the
driver; rows never do. The second pass projects row by row; its narrow result is written once and read for the
covariance of the whitened values and for the result.

Defined results. Rows whose vector is null, empty, or holds null or non-finite entries are left out. Vectors of
different lengths are separate fit lists. Rows that repeat, in id or vector, count and are returned each.
Entries so large that x leaves the range of +-2**62 count as that bound. A component whose variance is not
above 1e-12 of the total (a constant dimension, or fewer rows than dimensions) has null as whitened value and
takes no part in identity_error, which is null if no component is left. Where all vectors are equal, explained
is 0. A deviation beyond a long is null. An empty table gives no rows. Other columns are not handed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import stage

STEP, SHIFT = 1024, 100_000  # x = floor(STEP * c) + SHIFT
LARGEST = 1 << 62
BLOCK_ROWS = 8192
LIMB = 40  # bits of an entry that one long carries between tasks
NO_VARIANCE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """A fit list: rows, sums by dimension, unit components by falling variance, and all variances' sum."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total: float


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them finite numbers."""
    largest = F.lit(float("inf"))
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < largest))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def integers(vectors: np.ndarray) -> np.ndarray:
    """The integer x of each entry."""
    steps = np.floor(vectors.astype(np.float64) * STEP)
    return np.clip(steps, -float(LARGEST), float(LARGEST)).astype(np.int64) + SHIFT


def bit_planes(x: np.ndarray) -> np.ndarray:
    """The bits of non-negative integers (rows, dimensions) as words: (planes, dimensions, words)."""
    rows, dims = x.shape
    count = max(1, int(x.max(initial=0)).bit_length())
    padded = np.zeros((-(-rows // 64) * 64, dims), np.uint64)
    padded[:rows] = x
    return np.stack(
        [
            np.ascontiguousarray(np.packbits((padded >> np.uint64(b)).astype(np.uint8) & 1, axis=0).T).view(np.uint64)
            for b in range(count)
        ]
    )


def cross_products(x: np.ndarray) -> np.ndarray:
    """Sums over the rows of the products of any two columns, as Python integers; *x* holds integers of 64 bits."""
    rows, dims = x.shape
    least = x.min(axis=0)
    # As unsigned numbers, differences of 64-bit integers are right even where they leave the signed range.
    shifted = x.astype(np.uint64) - least.astype(np.uint64)
    planes = bit_planes(shifted)
    total = np.zeros((dims, dims), object)
    sums = np.zeros(dims, object)
    for p, left in enumerate(planes):
        sums += np.bitwise_count(left).sum(axis=1, dtype=np.int64).astype(object) << p
        for q in range(p, len(planes)):
            common = np.stack([np.bitwise_count(planes[q] & row).sum(axis=1, dtype=np.int64) for row in left])
            weighted = (common if p == q else common + common.T).astype(object) << (p + q)
            total += weighted
    low = least.astype(object)
    return total + np.outer(low, sums) + np.outer(sums, low) + rows * np.outer(low, low)


def _entries(dims: int, n: int, sums: np.ndarray, products: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """The count (-1, -1), the sums (i, -1) and the products (i, j), in pieces that add up as longs."""
    values = [(-1, -1, n)]
    values += [(i, -1, int(sums[i])) for i in range(dims)]
    values += [(i, j, int(products[i, j])) for i in range(dims) for j in range(i + 1)]
    for i, j, value in values:
        piece, rest = 0, abs(value)
        while rest or not piece:
            part = rest & ((1 << LIMB) - 1)
            yield dims, i, j, piece, part if value >= 0 else -part
            rest, piece = rest >> LIMB, piece + 1


def _scatter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The entries of the sums over a task's rows."""
    held: dict[int, list[np.ndarray]] = {}
    states: dict[int, list] = {}

    def add(dims: int) -> None:
        x = integers(np.concatenate(held.pop(dims)))
        state = states.setdefault(dims, [0, np.zeros(dims, object), np.zeros((dims, dims), object)])
        state[0] += len(x)
        state[1] += np.array([sum(map(int, column)) for column in x.T] if np.abs(x).max() > 1 << 40 else x.sum(axis=0).tolist(), object)
        state[2] += cross_products(x)

    for batch in batches:
        lengths = batch["v"].map(len).to_numpy()
        for dims in np.unique(lengths).tolist():
            rows = np.stack(batch["v"].to_numpy()[lengths == dims])
            for start in range(0, len(rows), BLOCK_ROWS):
                held.setdefault(dims, []).append(rows[start : start + BLOCK_ROWS])
                if sum(map(len, held[dims])) >= BLOCK_ROWS:
                    add(dims)
    for dims in list(held):
        add(dims)
    for dims, state in states.items():
        yield pd.DataFrame(_entries(dims, *state), columns=["dims", "i", "j", "piece", "value"])


def fit(vectors: DataFrame, vector: str = "embedding") -> dict[int, Whitening]:
    """The whitening of the usable vectors of each length."""
    rows = vectors.select(F.col(f"`{vector}`").alias("v")).where(usable(F.col("v")))
    entries = rows.mapInPandas(_scatter, "dims int, i int, j int, piece int, value long")
    found: dict[int, dict[tuple[int, int], int]] = {}
    for row in entries.groupBy("dims", "i", "j", "piece").agg(F.sum("value").alias("value")).collect():
        of = found.setdefault(row["dims"], {})
        of[row["i"], row["j"]] = of.get((row["i"], row["j"]), 0) + (row["value"] << (LIMB * row["piece"]))
    return {dims: _solve(dims, entries) for dims, entries in found.items()}


def _solve(dims: int, entries: dict[tuple[int, int], int]) -> Whitening:
    n = entries[-1, -1]
    sums = [entries[i, -1] for i in range(dims)]
    covariance = np.empty((dims, dims))
    centred = 0
    for i in range(dims):
        for j in range(i + 1):
            scatter = n * entries[i, j] - sums[i] * sums[j]
            covariance[i, j] = covariance[j, i] = scatter / (n * n)  # of integers: rounded once
            centred += scatter if i == j else 0
    variances, components = np.linalg.eigh(covariance)
    variances, components = variances[::-1], components[:, ::-1]
    largest = np.abs(components).argmax(axis=0)
    return Whitening(n, sums, components * np.sign(components[largest, np.arange(dims)]), variances, centred / (n * n))


def _projection(models: dict[int, Whitening], components: int):
    """Exact deviation and whitened values of vectors."""

    def one_length(x: np.ndarray, model: Whitening) -> tuple[list, np.ndarray]:
        most = int(np.abs(x).max())
        largest = model.n * most + max(map(abs, model.sums))
        if len(model.sums) * largest**2 < 1 << 63:
            centred = model.n * x - np.array(model.sums, np.int64)
            deviation = (centred * centred).sum(axis=1).tolist()
        else:
            centred = model.n * x.astype(object) - np.array(model.sums, object)
            deviation = [d if d < 1 << 63 else None for d in (centred * centred).sum(axis=1)]
        k = min(components, len(model.sums))
        scale = np.where(model.variances[:k] > NO_VARIANCE * model.total, model.variances[:k], np.nan) ** -0.5
        return deviation, (centred / model.n).astype(np.float64) @ model.components[:, :k] * scale

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(vectors: pd.Series) -> pd.DataFrame:
        deviations, values = np.empty(len(vectors), object), np.empty(len(vectors), object)
        lengths = vectors.map(len).to_numpy()
        for dims in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == dims)
            x = integers(np.stack(vectors.to_numpy()[at]))
            deviation, whitened = one_length(x, models[dims])
            deviations[at] = deviation
            for place, row in zip(at, whitened, strict=True):
                values[place] = row
        return pd.DataFrame({"deviation": pd.array(deviations.tolist(), "Int64"), "whitened": values})

    return project


def _identity_error(projected: DataFrame, dims: int, model: Whitening, components: int) -> float | None:
    """The largest absolute entry of the whitened values' covariance minus the identity."""
    k = min(components, dims)
    used = [c for c in range(k) if model.variances[c] > NO_VARIANCE * model.total]
    if not used:
        return None
    rows = projected.where(F.col("dims") == dims).select(*(F.col("whitened")[c].alias(f"w{c}") for c in used))
    means = rows.agg(*(F.avg(f"w{c}").alias(f"w{c}") for c in used)).first()
    centred = {c: F.col(f"w{c}") - F.lit(means[f"w{c}"]) for c in used}
    pairs = [(a, b) for a in used for b in used if a <= b]
    found = rows.agg(*(F.avg(centred[a] * centred[b]) for a, b in pairs)).first()
    return max(abs(value - (a == b)) for (a, b), value in zip(pairs, found, strict=True))


def whiten(vectors: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each usable vector and each of its first *components* whitened components.

    Columns: the key, component, n, deviation, whitened, explained, identity_error.
    """
    models = fit(vectors, vector)
    rows = vectors.select(F.col(f"`{key}`").alias(key), F.col(f"`{vector}`").alias("v")).where(usable(F.col("v")))
    projected = rows.select(key, F.size("v").alias("dims"), _projection(models, components)("v").alias("p"))
    projected = stage(projected.select(key, "dims", "p.deviation", "p.whitened"), "whitened")
    explained = {
        dims: [float(e / m.total) if m.total else 0.0 for e in np.maximum(m.variances, 0.0)[: min(components, dims)]]
        for dims, m in models.items()
    }
    errors = {dims: _identity_error(projected, dims, m, components) for dims, m in models.items()}
    fits = vectors.sparkSession.createDataFrame(
        [(dims, m.n, explained[dims], errors[dims]) for dims, m in models.items()],
        "dims int, n long, shares array<double>, identity_error double",
    )
    each = projected.join(F.broadcast(fits), "dims").select(  # one row for each length of vectors
        key, "n", "deviation", "shares", "identity_error", F.posexplode("whitened").alias("c", "w")
    )
    return each.select(
        key,
        (F.col("c") + 1).alias("component"),
        "n",
        "deviation",
        F.when(~F.isnan("w"), F.col("w")).alias("whitened"),
        F.col("shares")[F.col("c")].alias("explained"),
        "identity_error",
    )
