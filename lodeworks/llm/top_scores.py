"""Exact top-k search by inner product with a three-phase uniform threshold.

Method. The components of a vector are split over several lists; a list scores every row by its part of the inner
product. Phase 1: each list gathers its local best rows per query, over blocks of rows; the exact scores of
these rows give, per query, a safe cutoff: a score that the answer's last row reaches at least, own rows left out.
Phase 2: every list gets the cutoff divided by the number of lists, and returns all rows whose part reaches it; a row
below it in every list cannot reach the cutoff. Phase 3: what the unseen parts can add at most drops rows
that cannot reach the cutoff; the rest is scored exactly, block by block, and ranked.

Scale. Queries meet rows in blocks, as tasks of bounded size; cutoffs travel with their queries. Rows with equal
vectors are one row that keeps its k + 1 smallest ids, queries with equal vectors are asked once; so copies of
a vector, however many, cost one. Ranks are limited before they are shuffled.

Defined results. Vectors that are null or empty or hold null or non-finite components take no part, as rows without
vec_id. Ties go to the smaller vec_id. Rows that repeat vec_id and vector are one row; a vec_id with several
vectors is a candidate with each, but never for itself, and as a query it has the k best of all their pairs. Vectors of
different length are not compared. Scores are exact integers; those beyond a long are returned as its bound, and integers
beyond 2**62 count as that. Fewer than k other rows: all of them. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import sorted_groups, stage
from lodeworks.llm.vector_links import finite

LARGEST = 2.0**62
EXACT = 2.0**52  # sums of products below this are exact in doubles
FITS = 2.0**62  # and below this in longs
NO_CUTOFF = -(2**62)
BOUND = 2**60  # parts beyond it are handed on as it, and cutoffs are no higher than this for all lists together


def _most(queries: np.ndarray, rows: np.ndarray) -> float:
    """What no inner product exceeds."""
    return float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, queries.shape[1])


def _longs(values: np.ndarray, bound: int) -> np.ndarray:
    return np.array([max(-bound, min(bound, x)) for x in values.ravel()], np.int64).reshape(values.shape)


def _product(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point, which is faster, where that is exact."""
    most = _most(queries, rows)
    if most < EXACT:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    if most < FITS:
        return np.clip(queries @ rows.T, -BOUND, BOUND)
    return _longs(queries.astype(object) @ rows.astype(object).T, BOUND)


def _blocks(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), column), F.lit(n)).cast("int")


def _cell(lead: Column, q: Column, c: Column, q_blocks: int, c_blocks: int) -> Column:
    """One number for (lead, query block, row block)."""
    return ((lead.cast("long") * q_blocks + q) * c_blocks + c).alias("cell")


def _in_cells(df: DataFrame) -> DataFrame:
    """Rows by cell; a sort by a single number is a radix sort, where one by several columns compares rows."""
    return df.repartition("cell").sortWithinPartitions("cell")


def _met(classes: DataFrame, queries: DataFrame, lists: int, q_blocks: int, c_blocks: int) -> DataFrame:
    """Parts of queries and rows, dealt to the cells of (list, query block, row block)."""

    def part(k: Column) -> Column:
        size = F.ceil(F.col("dim") / lists).cast("int")
        return F.struct(k.alias("part"), F.slice("vector", k * size + 1, size).alias("values"))

    def dealt(df: DataFrame, is_query: bool, own: Column, others: Column, cutoff: Column) -> DataFrame:
        q, c = (F.col("own"), F.col("other")) if is_query else (F.col("other"), F.col("own"))
        parts = F.explode(F.transform(F.sequence(F.lit(0), F.lit(lists - 1)), part)).alias("p")
        return (
            df.select("node", "dim", cutoff.alias("cutoff"), parts, own.alias("own"))
            .withColumn("other", F.explode(others))
            .select(_cell(F.col("dim") * lists + F.col("p.part"), q, c, q_blocks, c_blocks), F.lit(is_query).alias("is_query"),
                    "node", "cutoff", "p.values")
        )

    none = F.lit(NO_CUTOFF)  # no nulls: pandas would make doubles of the column
    cutoff = F.col("cutoff") if "cutoff" in queries.columns else none
    all_c, all_q = (F.sequence(F.lit(0), F.lit(n - 1)) for n in (c_blocks, q_blocks))
    both = dealt(queries, True, _blocks("node", q_blocks), all_c, cutoff).union(
        dealt(classes, False, _blocks("node", c_blocks), all_q, none)
    )
    return _in_cells(both)


def _parts(batches):
    """Of each group: queries, rows, and the part scores of all of them."""
    for key, group in sorted_groups(batches, ["cell"]):
        asked = group["is_query"].to_numpy(bool)
        if asked.all() or not asked.any():
            continue
        values = np.stack([np.asarray(v, np.int64) for v in group["values"]])
        yield key, group[asked], group["node"].to_numpy()[~asked], _product(values[asked], values[~asked])


def _local_best(k: int):
    def best(batches):
        for _, queries, rows, scores in _parts(batches):
            take = min(k, len(rows))
            # Any k best rows give a safe cutoff, so ties need no order here.
            top = np.argpartition(-scores, take - 1, axis=1)[:, :take]
            yield pd.DataFrame(
                {
                    "query": np.repeat(queries["node"].to_numpy(), take),
                    "node": rows[top].ravel(),
                    "score": np.take_along_axis(scores, top, axis=1).ravel(),
                }
            )

    return best


def _sufficient(lists: int):
    def entries(batches):
        for _, queries, rows, scores in _parts(batches):
            # Without a cutoff there are fewer rows than an answer takes, and all of them are needed.
            cutoff = queries["cutoff"].to_numpy()
            limit = np.where(cutoff == NO_CUTOFF, np.iinfo(np.int64).min, cutoff // lists)
            q, c = np.nonzero(scores >= limit[:, None])
            yield pd.DataFrame({"query": queries["node"].to_numpy()[q], "node": rows[c], "score": scores[q, c]})

    return entries


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The inner products of pairs, as longs."""
    if _most(queries, rows) < FITS:
        return (queries * rows).sum(axis=1)
    return _longs((queries.astype(object) * rows.astype(object)).sum(axis=1), np.iinfo(np.int64).max)


def _resolve(batches):
    """Exact scores of the pairs of each (query block, row block), if they reach the cutoff."""
    for _, group in sorted_groups(batches, ["cell"]):
        kind = group["kind"].to_numpy()
        pairs = group[kind == 2]
        if pairs.empty:
            continue
        vectors = []
        for wanted, ids in ((0, pairs["query"]), (1, pairs["node"])):
            known = group[kind == wanted]
            at = pd.Index(known["node"]).get_indexer(ids)
            vectors.append((np.stack([np.asarray(v, np.int64) for v in known["vector"]]), at))
        (queries, q), (rows, c) = vectors
        cutoff = group["cutoff"].to_numpy()[kind == 0][q]
        cutoff = np.where(cutoff == NO_CUTOFF, np.iinfo(np.int64).min, cutoff)
        score = np.empty(len(pairs), np.int64)
        for start in range(0, len(pairs), 65_536):
            part = slice(start, start + 65_536)
            score[part] = _exact(queries[q[part]], rows[c[part]])
        keep = score >= cutoff
        yield pd.DataFrame({"query": pairs["query"].to_numpy()[keep], "node": pairs["node"].to_numpy()[keep], "score": score[keep]})


def top_scores(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    factor: float = 64.0,
    lists: int = 2,
    query_rows: int = 512,
    block_rows: int = 4096,
) -> DataFrame:
    """Per query of *vectors* (vec_id, embedding), ranked: query_id, rank, vec_id, score."""
    embedding = F.col("embedding").cast("array<double>")
    members = stage(
        vectors.where(finite(embedding) & F.col("vec_id").isNotNull()).select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform(embedding, lambda x: F.floor(F.greatest(F.least(x * factor, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long")).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        ).distinct(),
        "members",
    )
    classes = stage(
        members.groupBy("vector").agg(F.max("asks").alias("asks"))
        .select(F.monotonically_increasing_id().alias("node"), "vector", "asks", F.size("vector").alias("dim")),
        "classes",
    )
    named = members.join(classes.select("vector", "node"), "vector")
    # An id takes one place of a vector, so k + 1 different ids are enough of each. Of an asking vector's own ids, the one
    # that has most vectors takes so many places of its answer.
    ids = stage(
        named.select("node", "vec_id")
        .selectExpr("node", "vec_id", "row_number() OVER (PARTITION BY node ORDER BY vec_id) AS r")
        .where(F.col("r") <= k + 1)
        .select("node", "vec_id"),
        "ids",
    )
    asking = stage(named.where("asks").select(F.col("node").alias("query"), F.col("vec_id").alias("query_id")), "asking")
    vectors_of = members.groupBy("vec_id").agg(F.count("*").alias("n")).withColumnRenamed("vec_id", "query_id")
    own = asking.join(vectors_of, "query_id").groupBy(F.col("query").alias("node")).agg(F.max("n").alias("own"))
    queries = stage(classes.where("asks").join(own, "node").select("node", "dim", "vector", "own"), "queries")
    n, n_queries = classes.count(), queries.count()
    q_blocks, c_blocks = max(1, -(-n_queries // query_rows)), max(1, -(-n // block_rows))

    gathered = _met(classes, queries, lists, q_blocks, c_blocks).mapInPandas(_local_best(k + 1), "query long, node long, score long")
    # The best of each query over all lists and blocks; any choice is safe.
    first = (
        gathered.selectExpr("query", "node", "row_number() OVER (PARTITION BY query ORDER BY score DESC, node) AS r")
        .where(F.col("r") <= 4 * lists * (k + 1))
        .select("query", "node")
        .distinct()
    )
    # Doubles give these scores up to rounding, which is taken off; a lower cutoff is as safe.
    products = F.zip_with("asked", "vector", lambda a, b: a.cast("double") * b.cast("double"))
    sums = F.aggregate(products, F.lit(0.0), lambda s, x: s + x), F.aggregate(products, F.lit(0.0), lambda s, x: s + F.abs(x))
    low = F.floor(F.least(F.greatest(sums[0] - 1e-9 * sums[1], F.lit(-float(BOUND))), F.lit(float(BOUND))) / lists).cast("long") * lists
    cutoffs = (
        first.join(classes.select("node", "vector"), "node")
        .join(queries.select(F.col("node").alias("query"), F.col("vector").alias("asked"), "own"), "query")
        .select("query", "own", low.alias("score"))
        .groupBy("query", "own")
        .agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
        .select("query", F.get("scores", (F.col("own") + k - 1).cast("int")).alias("cutoff"))
    )
    asked = queries.join(cutoffs.withColumnRenamed("query", "node"), "node", "left")
    asked = stage(asked.withColumn("cutoff", F.coalesce("cutoff", F.lit(NO_CUTOFF))), "cutoffs")

    entries = _met(classes, asked, lists, q_blocks, c_blocks).mapInPandas(_sufficient(lists), "query long, node long, score long")
    seen = entries.groupBy("query", "node").agg(F.sum("score").alias("part"), F.count("*").alias("lists_seen"))

    def cell(q: Column, c: Column) -> Column:
        return _cell(F.col("dim"), q, c, q_blocks, c_blocks)

    none = F.lit(NO_CUTOFF).alias("cutoff")
    # An unseen part times the number of lists is below the cutoff.
    unseen = (lists - F.col("lists_seen")) * (F.expr(f"cutoff div {lists}") - 1)
    pairs = (
        seen.join(asked.select(F.col("node").alias("query"), "cutoff", "dim"), "query")
        .where((F.col("cutoff") == NO_CUTOFF) | (F.col("part") + unseen >= F.col("cutoff")))
        .select(cell(_blocks("query", q_blocks), _blocks("node", c_blocks)), F.lit(2).alias("kind"), "query", "node", none)
    )
    other, own_query = F.col("other"), F.lit(-1).cast("long").alias("query")
    meet = (
        asked.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
        .select(cell(_blocks("node", q_blocks), other), F.lit(0).alias("kind"), "node", "vector", "cutoff", own_query)
        .unionByName(
            classes.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
            .select(cell(other, _blocks("node", c_blocks)), F.lit(1).alias("kind"), "node", "vector", none, own_query),
            allowMissingColumns=True,
        )
        .unionByName(pairs, allowMissingColumns=True)
    )
    scored = _in_cells(meet).mapInPandas(_resolve, "query long, node long, score long")
    candidates = scored.join(ids, "node").join(queries.select(F.col("node").alias("query"), "own"), "query")
    best = candidates.selectExpr(
        "query", "vec_id", "score", "own", "row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS r"
    ).where(F.col("r") <= F.col("own") + k)
    return (
        asking.join(best, "query")
        .where("vec_id <> query_id")
        .selectExpr("query_id", "vec_id", "score", "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank")
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
