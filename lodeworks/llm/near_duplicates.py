"""Near duplicates by an LSH forest over MinHash signatures, confirmed on whole shingle sets.

Method. A document's words give its set of word shingles, as 64-bit hashes. Documents with equal sets
form a class, and one of them stands for it. A signature of trees x DEPTH minima has a part for each tree.
Rows that share a prefix of a tree's part, of the same length everywhere, form a region: what lies together in
the tree's sorted order, grouped by hash in place of a sort. The prefix is as long as the threshold allows, however
many rows a region holds: splitting a large one at a longer prefix would lose pairs. Rows of one region are joined loosely (each with the region's first: one edge a row); loose groups
are then compared in blocks: pairs whose signatures agree enough, best first, are confirmed by the exact
100 * intersection >= percent * union, except pairs that links found before already connect.

Scale. Copies are collapsed by a grouped minimum before anything is joined. No pair is written: a task
returns at most one link per row that it holds. Groups larger than a block are compared as pairs of
blocks in tasks of their own: unlike texts that share a region cost comparisons, in blocks, with the square
of their group. The chance to miss a lone pair right at the threshold is below 2e-4.

Defined results. Null and empty texts, and texts of white space only, have no shingles and link with
nothing. Rows without doc_id link with nothing, and their component is null. Rows that share a doc_id
count as one document. Extra columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import Forest, Memo, components, small_batches, sorted_groups, stage

DEPTH = 8
MISS = 2e-4


@functools.cache
def _word_hashes() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of *words* words; of all words where there are fewer."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII white space
    if not found:
        return np.empty(0, np.uint64)
    each = np.array(list(map(_word_hashes().__getitem__, found)), np.uint64)
    span = min(words, len(each))
    mixed = np.full(len(each) - span + 1, span, np.uint64)
    for k in range(span):
        mixed = (mixed ^ each[k : len(each) - span + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


@functools.cache
def _factors(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return tuple(rng.integers(1, 2**63, (2, size, 1), dtype=np.uint64) | np.uint64(1))


def signature(hashes: np.ndarray, size: int) -> np.ndarray:
    """*size* MinHash values as 32-bit integers."""
    a, b = _factors(size)
    low = np.full(size, 2**64 - 1, np.uint64)
    for start in range(0, len(hashes), 256):
        low = np.minimum(low, (hashes[None, start : start + 256] * a + b).min(axis=1))
    low ^= low >> np.uint64(31)
    return (low * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def least_depth(percent: int, trees: int) -> int:
    """The deepest prefix at which the chance to miss a pair at the threshold stays below MISS."""
    fits = [d for d in range(1, DEPTH + 1) if (1 - (percent / 100) ** d) ** trees <= MISS]
    return max(fits, default=1)


def summaries(docs: DataFrame, words: int, trees: int) -> DataFrame:
    """Per row: doc_id, size of the shingle set, its 128-bit fingerprint, and its signature."""

    @F.pandas_udf("n int, print binary, sig array<int>")
    def summary(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            own = shingles(text, words)
            if len(own):
                out.append((len(own), xxhash.xxh3_128_digest(own.tobytes()), signature(own, trees * DEPTH)))
            else:
                out.append((0, None, None))
        return pd.DataFrame(out, columns=["n", "print", "sig"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), summary(F.col("text")).alias("s")).select(
        "doc_id", "s.*"
    )


def _regions(classes: DataFrame, percent: int, trees: int) -> DataFrame:
    """Loose edges (a, b): every row of a region with the region's first."""
    depth = least_depth(percent, trees)
    keys = F.array(*(F.xxhash64(F.lit(t), F.slice("sig", t * DEPTH + 1, depth)) for t in range(trees)))
    rows = classes.select("node", F.explode(keys).alias("k"))
    regions = rows.groupBy("k").agg(F.count("*").alias("rows"), F.min("node").alias("first")).where("rows > 1")
    return rows.join(regions, "k").select(F.col("node").alias("a"), F.col("first").alias("b")).where("a <> b")


def _confirm(percent: int, trees: int):
    """For the rows of one group or pair of blocks: a forest of confirmed links."""
    size = trees * DEPTH
    share = percent / 100
    agree = int(size * (share - 4.5 * (share * (1 - share) / size) ** 0.5))

    def links(batches):
        for (_, i, j), rows in sorted_groups(batches, ["cluster", "i", "j"]):
            nodes, part = rows["node"].to_numpy(), rows["part"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in rows["hashes"]]
            sizes = np.array([len(x) for x in sets])
            sigs = np.stack(rows["sig"].to_list())
            pairs = []
            for x in range(len(rows) - 1):
                rest = slice(x + 1, None)
                same = (sigs[rest] == sigs[x]).sum(axis=1)
                fits = (same >= agree) & (
                    100 * np.minimum(sizes[rest], sizes[x]) >= percent * np.maximum(sizes[rest], sizes[x])
                )
                if i != j:
                    fits &= part[rest] != part[x]  # pairs within a block have a task of their own
                y = np.flatnonzero(fits)
                pairs.append(np.stack([same[y], np.full(len(y), x), y + x + 1]))
            if not pairs:
                continue
            pairs = np.concatenate(pairs, axis=1)
            forest, found = Forest(len(rows)), []
            for k in np.argsort(-pairs[0], kind="stable"):
                x, y = int(pairs[1, k]), int(pairs[2, k])
                if forest.find(x) == forest.find(y):
                    continue
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    forest.join(x, y)
                    found.append((nodes[x], nodes[y]))
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return links


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    trees: int = 12,
    region_rows: int = 4096,
    block_rows: int = 256,
) -> DataFrame:
    """Per row of *docs* (doc_id, text): doc_id, n_shingles, component_id (smallest doc_id), kept.

    *region_rows* is accepted as before and has no effect: regions of any size keep their edges.
    """
    seen = stage(summaries(docs, words, trees), "summaries")
    named = seen.where("n > 0 AND doc_id IS NOT NULL")
    classes = stage(
        named.groupBy("print").agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig")), "classes"
    )
    loose = components(_regions(classes, percent, trees))
    sized = loose.join(loose.groupBy("component").agg(F.count("*").alias("rows")), "component")
    wanted = classes.join(sized, "node").select(
        "node", "print", "sig", F.col("component").alias("cluster"), F.ceil(F.col("rows") / block_rows).alias("blocks")
    )

    @F.pandas_udf("print binary, hashes binary")
    def whole_set(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(text, words).tobytes() for text in texts]
        return pd.DataFrame({"print": [xxhash.xxh3_128_digest(x) for x in sets], "hashes": sets})

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").alias("text"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = F.transform(
        F.sequence(F.lit(0), F.col("blocks").cast("int") - 1),
        lambda other: F.struct(F.least(other, own).alias("i"), F.greatest(other, own).alias("j")),
    )
    dealt = (
        wanted.join(texts, "node")
        .withColumn("found", whole_set("text"))
        .where("found.print = print")
        .select("cluster", "node", "sig", "found.hashes", own.alias("part"), F.explode(every).alias("p"))
        .select("cluster", "p.i", "p.j", "part", "node", "sig", "hashes")
        .repartition("cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j", "node")
    )
    links = dealt.mapInPandas(_confirm(percent, trees), "a long, b long")
    linked = components(links).withColumnRenamed("component", "component_id")
    of_print = classes.select("print", "node").join(linked, "node", "left")
    component = F.coalesce("component_id", "node", "doc_id")
    return seen.join(
        of_print, (seen["print"] == of_print["print"]) & seen["doc_id"].isNotNull(), "left"
    ).select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
