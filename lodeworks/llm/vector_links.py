"""Links between vectors of one label whose cosine reaches a threshold: an exact metric range join.

Method. On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c). Pivots, drawn by hash
from each large label, partition its vectors: each is at home with its nearest pivot. A pair across two
cells is found in the later one: the vector x of cell p is copied to cell q only if it can lie within
reach of the boundary. By the triangle inequality d(x, q) - d(x, p) is then at most twice the reach, and x is
no further than the reach from the plane between both pivots. Cells are joined independently, in
blocks: pairs of blocks are tasks of their own, so a cell of any size keeps tasks small.

Scale. Equal vectors are one row with a count. A task returns, for each row, the number of its links
and one edge towards the smallest row it reaches, never the pairs. Pivots are few (at most PIVOTS for each
of the LABELS largest labels, whatever the table holds) and only save work: smaller labels are one cell.

Defined results. Vectors that are null, empty or zero or hold null or non-finite components, and rows without
label or vec_id, link with nothing; without vec_id the component is null. Vectors of different length are
not compared. Repeated rows are vectors of their own. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import components, sorted_groups, stage

LABELS, PIVOTS = 64, 64
KEYS = ["label", "dim", "cell", "kind", "i", "j"]


def finite(vector: Column) -> Column:
    """Whether all components are there and finite, and there are some."""
    # A comparison with null is null; coalesce makes it false.
    each = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & each, F.lit(False))


def _pivots(classes: DataFrame, cell_rows: int) -> dict[tuple[int, int], np.ndarray]:
    large = (
        classes.groupBy("label", "dim").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows)
        .orderBy(F.desc("n"), "label", "dim").limit(LABELS)
    )
    want = F.least(F.lit(PIVOTS), F.ceil(F.col("n") / cell_rows))
    # Rows with small hashes, about twice as many as are wanted; then the smallest of them.
    drawn = F.shiftrightunsigned(F.xxhash64("node", F.lit("pivot")), 11) / F.lit(float(2**53))
    found = (
        classes.join(F.broadcast(large), ["label", "dim"])
        .withColumns({"want": want, "drawn": drawn})
        .where(F.col("drawn") < 2 * F.col("want") / F.col("n"))
        .selectExpr("label", "dim", "embedding", "want", "row_number() OVER (PARTITION BY label, dim ORDER BY drawn, node) AS r")
        .where("r <= want")
        .orderBy("label", "dim", "r")
        .collect()
    )
    out: dict[tuple[int, int], list] = {}
    for r in found:
        out.setdefault((r["label"], r["dim"]), []).append(r["embedding"])
    return {k: _unit(np.array(v, float)) for k, v in out.items()}


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # against overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _dealt(classes: DataFrame, pivots: dict, reach: float) -> DataFrame:
    """Each class at home in its cell, and copied to later cells whose boundary it can reach."""
    held = classes.sparkSession.sparkContext.broadcast(pivots)

    @F.pandas_udf("home int, others array<int>")
    def cells(label: pd.Series, vectors: pd.Series) -> pd.DataFrame:
        home, others = np.zeros(len(vectors), int), [[] for _ in vectors]
        keys = pd.Series([(k, len(v)) for k, v in zip(label, vectors, strict=True)])
        for key, rows in keys.groupby(keys).groups.items():
            own = held.value.get(key)
            if own is None:
                continue
            x = _unit(np.stack(vectors[rows].to_list()).astype(float))
            square = np.maximum(0, 2 - 2 * x @ own.T)
            nearest = square.argmin(axis=1)
            to_own = square[np.arange(len(x)), nearest]
            between = np.sqrt(np.maximum(0, 2 - 2 * own @ own.T))[nearest]
            near = np.sqrt(square) - np.sqrt(to_own)[:, None] <= 2 * reach
            near &= square - to_own[:, None] <= 2 * reach * between + 1e-9
            near &= np.arange(len(own)) > nearest[:, None]
            for k, row, cell in zip(rows, near, nearest, strict=True):
                home[k], others[k] = cell, np.flatnonzero(row).tolist()
        return pd.DataFrame({"home": home, "others": others})

    at = F.concat(
        F.array(F.struct(F.col("c.home").alias("cell"), F.lit(True).alias("home"))),
        F.transform("c.others", lambda cell: F.struct(cell.alias("cell"), F.lit(False).alias("home"))),
    )
    return classes.withColumn("c", cells("label", "embedding")).select(
        "node", "copies", "label", "dim", "embedding", F.explode(at).alias("at")
    ).select("node", "copies", "label", "dim", "embedding", "at.*")


def _tasks(dealt: DataFrame, block_rows: int) -> DataFrame:
    """Rows with the blocks they meet: home blocks with each other, and with blocks of copied rows."""
    sizes = dealt.groupBy("label", "dim", "cell").agg(
        F.ceil(F.count_if("home") / block_rows).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("home")) / block_rows).cast("int").alias("guests"),
    )
    rows = dealt.join(sizes, ["label", "dim", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("guests"))).cast("int")
    )

    def each(n: Column, make) -> Column:
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), make)

    def pair(kind: int, i: Column, j: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))

    part = F.col("part")
    inner = each(F.col("homes"), lambda k: pair(0, F.least(k, part), F.greatest(k, part)))
    across = each(F.col("guests"), lambda k: pair(1, part, k))
    guest = each(F.col("homes"), lambda k: pair(1, k, part))
    meets = F.when(F.col("home"), F.concat(inner, across)).otherwise(guest)
    return (
        rows.select("label", "dim", "cell", "node", "copies", "embedding", "home", "part", F.explode(meets).alias("m"))
        .select("label", "dim", "cell", "m.*", "node", "copies", "embedding", "home", "part")
        .repartition(*KEYS)
        .sortWithinPartitions(*KEYS, "node")
    )


def _found(threshold: float):
    def links(batches):
        for (_, _, _, kind, i, j), rows in sorted_groups(batches, KEYS):
            raw = np.stack(rows["embedding"].to_list()).astype(float)
            x = _unit(raw)
            cosine = x @ x.T
            linked = cosine >= threshold
            scaled = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1, keepdims=True))[1])  # keeps squares within doubles
            for a, b in np.argwhere(np.abs(cosine - threshold) < 1e-12):  # rounding decides here: add exactly
                dot, p, q = (math.fsum(u * v) for u, v in ((scaled[a], scaled[b]), (scaled[a], scaled[a]), (scaled[b], scaled[b])))
                linked[a, b] = dot / math.sqrt(p) / math.sqrt(q) >= threshold
            np.fill_diagonal(linked, False)
            side = rows["home" if kind else "part"].to_numpy()
            if kind or i != j:
                linked &= side[:, None] != side[None, :]
            if not linked.any():
                continue
            n_links = linked @ rows["copies"].to_numpy(np.int64)
            group = np.arange(len(rows))  # rows are in the order of node
            while True:
                least = np.minimum(group, np.where(linked, group[None, :], len(rows)).min(axis=1))
                least = least[least]
                if (least == group).all():
                    break
                group = least
            nodes = rows["node"].to_numpy()
            yield pd.DataFrame({"a": nodes, "b": nodes[group], "links": n_links})[n_links > 0]

    return links


def link_vectors(
    vectors: DataFrame, min_cosine: float = 0.93, cell_rows: int = 2048, block_rows: int = 512
) -> DataFrame:
    """Per row of *vectors* (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    embedding = F.col("embedding").cast("array<double>")
    usable = finite(embedding) & F.exists(embedding, lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    seen = stage(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            embedding.alias("embedding"),
            F.coalesce(usable, F.lit(False)).alias("usable"),
        ),
        "vectors",
    )
    classes = stage(
        seen.where("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
        .withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("embedding")}),
        "classes",
    )
    pivots = _pivots(classes, cell_rows)
    reach = math.sqrt(max(0.0, 2 - 2 * min_cosine)) + 1e-9
    dealt = _tasks(_dealt(classes, pivots, reach), block_rows)
    found = stage(dealt.mapInPandas(_found(min_cosine), "a long, b long, links long"), "links")
    counts = found.groupBy("a").agg(F.sum("links").alias("links"))
    linked = components(found.select("a", "b"))
    # A component is named by its least vec_id; ids may have several vectors, so they cannot stand for them before.
    names = linked.join(classes.select("node", "least_id"), "node").groupBy("component").agg(F.min("least_id").alias("least"))
    linked = linked.join(stage(names, "names"), "component").select(F.col("node").alias("of"), F.col("least").alias("component"))
    known = (
        classes.join(counts, classes["node"] == counts["a"], "left")
        .join(linked, F.col("node") == F.col("of"), "left")
        .select(
            F.col("label").alias("own_label"),
            F.col("embedding").alias("own_embedding"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "least_id").alias("component"),
        )
    )
    component = F.coalesce("component", "vec_id")
    return seen.join(
        known, F.col("usable") & (F.col("label") == F.col("own_label")) & (F.col("embedding") == F.col("own_embedding")), "left"
    ).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
