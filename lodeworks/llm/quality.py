"""Quality of whole texts: logistic regression over hashed word n-grams, trained with FTRL-proximal.

Method. Words and runs of marks are tokens. Features are single tokens, pairs of neighbours, and single,
paired and tripled token shapes (case, digits, kind of mark, repeats of the last token), hashed into
2**bits places. Their value is the relative frequency within the text, so that long texts weigh no
more than short ones. Training follows the regularised leader: per coordinate, with L1 and L2 terms, which leaves
weights of rare features at exactly zero. A score is a sparse dot product.

Scale. A model is trained on at most *sample* labelled rows, those with the smallest hashes, in one task
that holds the features of all of them and returns the weights that are not zero, 2**bits at most. Scoring reads each
text once, where it lies.

Defined results. Null and empty texts have no features and score as the constant. Without labelled rows
every score is 0.5; an empty table gives no rows. Rows without doc_id are never learned from. Repeated rows score alike.
"""

from __future__ import annotations

import functools
import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import Memo, held_out, small_batches, stage

TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+|\n")
SHAPES = 16


def _shape(token: str) -> int:
    if token == "\n":
        return 1
    if token.isalpha():
        if token.islower():
            return 2 + min(2, len(token) // 5)
        if token.isupper():
            return 5 if len(token) == 1 else 6
        return 7 if token[1:].islower() or len(token) == 1 else 8
    if token.isdigit():
        return 9
    if token.isalnum():
        return 10
    return 11 if token in (".", ",") else 12 if len(token) == 1 else 13 if len(set(token)) == 1 else 14


@functools.cache
def _tokens() -> Memo:
    """A token's hash, with its shape in the lowest bits."""
    return Memo(lambda t: xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) & ~(SHAPES - 1) | _shape(t))


def features(text: str | None, bits: int) -> np.ndarray:
    """Places of all features of the text, each as often as it occurs."""
    tokens = TOKEN.findall(text or "")
    if not tokens:
        return np.empty(0, np.int64)
    h = np.array(list(map(_tokens().__getitem__, tokens)), np.uint64)
    shape = h & np.uint64(SHAPES - 1)
    again = np.zeros(len(h), np.uint64)
    again[1:] = h[1:] == h[:-1]
    shape = shape * np.uint64(2) + again
    kinds = [h, h[:-1] * np.uint64(31) + h[1:], shape + np.uint64(1 << 20)]
    kinds.append(shape[:-1] * np.uint64(64) + shape[1:] + np.uint64(1 << 30))
    kinds.append((shape[:-2] * np.uint64(64) + shape[1:-1]) * np.uint64(64) + shape[2:] + np.uint64(1 << 40))
    mixed = np.concatenate(kinds) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Model:
    bits: int
    constant: float
    weights: np.ndarray  # of all places

    def score(self, text: str | None) -> float:
        at = features(text, self.bits)
        x = self.constant + (float(self.weights[at].mean()) * SCALE if len(at) else 0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


SCALE = 20.0  # relative frequencies are small; this puts typical steps near one


def ftrl(rows, bits: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[float, np.ndarray]:
    """Constant and weights after *epochs* over *rows* (places, values, label)."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        own = z[at]
        w = -(own - np.sign(own) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(own) > l1, w, 0.0)

    for _ in range(epochs):
        for at, value, label in rows:
            w = weights(at)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w @ value)))))
            g = (p - label) * value
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    found = weights(np.arange(size + 1))
    return float(found[size]), found[:size]


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 12_000,
    bits: int = 18,
    epochs: int = 3,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.1,
) -> Model:
    """A model from the rows of *labels* (doc_id, quality) that are not held out, and their texts."""
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    @F.pandas_udf("at array<int>, n array<int>")
    def counted(texts: pd.Series) -> pd.DataFrame:
        found = [np.unique(features(text, bits), return_counts=True) for text in texts]
        return pd.DataFrame({"at": [a.astype(np.int32) for a, _ in found], "n": [n.astype(np.int32) for _, n in found]})

    # At most *sample* pairs of numbers are broadcast.
    rows = stage(
        small_batches(docs).select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select(F.xxhash64("doc_id").alias("order"), "label", counted("text").alias("f"))
        .select("order", "label", "f.*"),
        "training",
    )

    def learn(batches):
        held = []
        for batch in batches:
            for at, n, label in zip(batch["at"], batch["n"], batch["label"], strict=True):
                total = max(1, int(n.sum()))
                held.append((np.append(at, 1 << bits).astype(np.int32), np.append(n / total * SCALE, 1.0).astype(np.float32), int(label)))
        if held:
            constant, weights = ftrl(held, bits, epochs, alpha, beta, l1, l2)
            at = np.flatnonzero(weights)
            yield pd.DataFrame({"place": np.append(at, -1), "weight": np.append(weights[at], constant)})

    # One task for a bounded sample: the leader follows one order of rows.
    found = rows.repartition(1).sortWithinPartitions("order").mapInPandas(learn, "place long, weight double").toPandas()
    weights, constant = np.zeros(1 << bits, np.float32), 0.0
    for place, weight in zip(found["place"], found["weight"], strict=True):
        if place < 0:
            constant = float(weight)
        else:
            weights[int(place)] = weight
    return Model(bits, constant, weights)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """*docs* with ``quality_score`` (0 to 1); an incoming column of this name gives way."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([held.value.score(text) for text in texts], dtype=float)

    return small_batches(docs).withColumn("quality_score", scored("text"))
