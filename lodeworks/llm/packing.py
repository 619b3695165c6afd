"""Packing of token pieces into sequences: vector best fit over residual capacities.

Method. A bin has three capacities: tokens, documents and attention cost (the sum of squared lengths).
Items go in falling length. Of the open bins whose residuals hold the item under every constraint, it
takes the one with the smallest norm of what is left (rule "norm"), or the largest weighted dot product
of residual and demand (rule "dot"). A new bin is opened only if none fits. All three residuals count in
the choice, also those of capacities that the tokens imply.

Scale. Equal lengths are interchangeable, and so are bins with equal residuals. The plan is therefore made
for counts: from the histogram of lengths (one row for each of at most *tokens* lengths, whatever the
table's size) to runs of ranks within a length that go to runs of bins. The histogram is all that the
driver sees. A length ends in at most one run of bins, so the plan is bounded by the number of lengths and
of items a bin holds, not of rows. Rows then get
their rank within their length, from counts per length and shard and a position within the shard, so
that a length with a third of all rows is numbered by many tasks; a lookup in the plan gives the place.
Attention costs are exact.

Defined results. A null text is an empty document, which still has its closing token. Rows are packed
one by one, so repeated rows get places of their own. Items longer than a bin, and items without a
length of at least 1, are refused. Other columns are handed on; incoming ones named sequence_id or
offset give way. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from lodeworks.llm.common import small_batches, stage

SHARD_ROWS = 50_000


@functools.cache
def _tokenizer(path: str) -> tuple[Tokenizer, list[bytes]]:
    """The tokenizer, and every id as four bytes."""
    tokenizer = Tokenizer.from_file(path)
    return tokenizer, [k.to_bytes(4, "little") for k in range(max(tokenizer.get_vocab().values()) + 1)]


class Words(dict):
    """Ids of words as unsigned 32-bit little-endian bytes. No token of this tokenizer spans white space.

    A word of letters alone is one piece for the tokenizer's model, after lower case and the byte
    alphabet; asking the model directly saves most of the time. A stop behind it is a piece of its own.

    What is known is dropped by its size in bytes, between batches: ``trim`` makes the words an older
    generation when they exceed *budget*, and those asked for again come back from it.
    """

    ENTRY = 200  # bytes of a short word, its ids and their place in the dictionary

    def __init__(self, path: str, budget: int = 64 << 20):
        super().__init__()
        self.tokenizer, self.four = _tokenizer(path)
        self.model = self.tokenizer.model
        self.bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.budget, self.held, self.older = budget, 0, {}
        self.stops = {stop: self.whole(stop) for stop in ".,"}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        self.held += self.ENTRY + 2 * len(ids)
        self[word] = ids
        return ids

    def trim(self) -> None:
        if self.held > self.budget:
            self.older, self.held = dict(self), 0
            self.clear()

    def whole(self, text: str) -> bytes:
        return b"".join(map(self.four.__getitem__, self.tokenizer.encode(text, add_special_tokens=False).ids))

    def encode(self, word: str) -> bytes:
        stop = self.stops.get(word[-1])
        if stop and word[-2:-1].isalpha():
            stem = word[:-1]
            return (self.get(stem) or self.older.get(stem) or self.encode(stem)) + stop
        if word.isalpha():
            low = word.lower()
            if not word.isascii():
                if "\u03a3" in word or not (low.isalpha() and unicodedata.is_normalized("NFC", word)):
                    return self.whole(word)
                low = self.bytes(low)[0][0]
            return b"".join([self.four[t.id] for t in self.model.tokenize(low)])
        return self.whole(word)

    def text(self, text: str, closing_id: int) -> bytes:
        if any(c in text for c in _SEPARATORS):
            ids = self.whole(text)
        else:
            ids = b"".join(map(self.__getitem__, (text.lower() if text.isascii() else text).split()))
        return ids + closing_id.to_bytes(4, "little")


# str.split() takes these for white space, the tokenizer does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def encode_text(text: str, path: str, closing_id: int) -> bytes:
    return Words(path).text(text, closing_id)


def pieces(docs: DataFrame, tokenizer: str, tokens: int = 4096, closing_id: int = 1) -> DataFrame:
    """Token pieces: doc_id, piece, start, length, ids (unsigned 32-bit little-endian)."""

    @F.pandas_udf("binary")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Words(tokenizer)  # known for the length of a task
        for texts in batches:
            yield pd.Series([words.text(text or "", closing_id) for text in texts], dtype=object)
            words.trim()

    count = (F.length("all_ids") / 4).cast("int")
    cut = F.posexplode(F.sequence(F.lit(0), count - 1, F.lit(tokens))).alias("piece", "start")
    return (
        small_batches(docs).select("doc_id", encoded("text").alias("all_ids"))
        .select("doc_id", "all_ids", count.alias("count"), cut)
        .select(
            "doc_id",
            "piece",
            F.col("start").cast("long").alias("start"),
            F.least(F.lit(tokens), F.col("count") - F.col("start")).cast("long").alias("length"),
            F.expr(f"substring(all_ids, start * 4 + 1, {tokens * 4})").alias("ids"),
        )
    )


class Plan:
    """Where ranks within a length go: runs (length, first rank) -> (first sequence, offset)."""

    def __init__(self, runs: list[tuple[int, int, int, int]], sequences: int):
        runs = np.array(sorted(runs), np.int64).reshape(-1, 4)
        self.start = (runs[:, 0] << 44) + runs[:, 1]
        self.rank, self.sequence, self.offset = runs[:, 1], runs[:, 2], runs[:, 3]
        self.sequences = sequences

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.start, (length << 44) + rank, side="right") - 1
        return self.sequence[k] + rank - self.rank[k], self.offset[k]


def make_plan(
    histogram: Sequence[tuple[int, int]],
    tokens: int,
    documents: int,
    attention: int,
    weights: Sequence[float] = (1.0, 1.0, 1.0),
    rule: str = "norm",
) -> Plan:
    """The plan for a histogram of (length, count): that of placing the items one by one."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule}")
    full = np.array([tokens, documents, attention], np.int64)
    scale = np.array(weights) / np.maximum(full, 1)
    open_bins: dict[tuple, list[list[int]]] = {}  # residual -> runs of bins [first, count]
    left = np.empty((0, 3), np.int64)  # residuals that are open, in rows
    runs, sequences = [], 0

    def add(residual: np.ndarray, first: int, count: int) -> None:
        nonlocal left
        if not count or (residual <= 0).any():
            return
        key = tuple(residual.tolist())
        if key not in open_bins:
            open_bins[key] = []
            left = np.vstack([left, residual])
        open_bins[key].append([first, count])

    for length, count in sorted(histogram, reverse=True):
        if not 1 <= length <= tokens:
            raise ValueError(f"an item of {length} tokens does not fit a sequence of {tokens}")
        demand = np.array([length, 1, length * length], np.int64)
        if (demand > full).any():
            raise ValueError(f"an item of {length} tokens exceeds a capacity by itself")
        rank = 0
        while rank < count:
            fits = np.flatnonzero((left >= demand).all(axis=1))
            if len(fits):
                if rule == "norm":
                    score = -(((left[fits] - demand) * scale) ** 2).sum(axis=1)
                else:
                    score = ((left[fits] * scale) * (demand * scale)).sum(axis=1)
                k = fits[np.argmax(score)]
                residual = left[k].copy()
                key = tuple(residual.tolist())
                first, there = open_bins[key].pop()
                if not open_bins[key]:
                    del open_bins[key]
                    left = np.delete(left, k, axis=0)
                # By the norm a bin that has taken an item is the best one for the next alike; by the dot product the last one.
                each = int((residual // demand).min()) if rule == "norm" else 1
            else:
                residual, first = full, sequences
                each = int((full // demand).min())
                there = -(-(count - rank) // each)
                sequences += there
            bins = min(there, (count - rank) // each)
            last = min(count - rank - bins * each, each) if bins < there else 0
            for items, at, number in ((each, first, bins), (last, first + bins, 1)):
                for k in range(items if number else 0):
                    runs.append((length, rank, at, tokens - int(residual[0]) + k * length))
                    rank += number
            add(residual, first + bins + (last > 0), there - bins - (last > 0))
            add(residual - demand * each, first, bins)
            if last:
                add(residual - demand * last, first + bins, 1)
    return Plan(runs, sequences)


def pack(
    items: DataFrame,
    tokens: int = 4096,
    documents: int = 4096,
    attention: int = 4096 * 4096,
    weights: Sequence[float] = (1.0, 1.0, 1.0),
    rule: str = "norm",
) -> DataFrame:
    """*items*, which have a ``length``, with sequence_id and offset."""
    items = stage(items.drop("sequence_id", "offset"), "items")
    spark = items.sparkSession
    histogram = [(r[0] or 0, r[1]) for r in items.groupBy("length").count().collect()]
    plan = spark.sparkContext.broadcast(make_plan(histogram, tokens, documents, attention, weights, rule))
    shards = max(1, -(-max((n for _, n in histogram), default=0) // SHARD_ROWS))

    row = F.struct(*(F.col(f"`{c}`") for c in items.columns))
    packed = items.select(row.alias("row"), F.col("length").alias("len"), F.xxhash64(row).alias("mark"))
    packed = packed.withColumn("shard", F.pmod("mark", F.lit(shards)).cast("int"))
    before = (
        packed.groupBy("len", "shard")
        .count()
        .selectExpr("len", "shard", "sum(count) OVER (PARTITION BY len ORDER BY shard) - count AS before")
    )
    ranked = packed.selectExpr(
        "row", "len", "shard", "row_number() OVER (PARTITION BY len, shard ORDER BY mark) - 1 AS place"
    )

    @F.pandas_udf("sequence_id long, offset long")
    def located(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.value.places(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.join(before, ["len", "shard"]).select(
        *(F.col(f"row.`{c}`").alias(c) for c in items.columns),
        located(F.col("len").cast("long"), F.col("before") + F.col("place")).alias("at"),
    ).select(*(f"`{c}`" for c in items.columns), "at.sequence_id", "at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences from packed pieces with their ids: sequence_id, length, ids. Each holds one bin at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(parts, F.expr("X''"), lambda all_ids, part: F.concat(all_ids, part["ids"])).alias("ids"),
    )
