"""What several operators share: staged tables, word caches, sorted groups, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """Write *df* once to storage that all executors share, and continue from the written table.

    The folder is ``spark.checkpoint.dir``; where that is unset, a folder of the warehouse. A task holds a row group
    at least, when it writes and again when it reads: *group_rows* bounds that where single rows are large.
    """
    spark = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.conf.get("spark.sql.warehouse.dir") + "/staged"
    path = f"{shared.rstrip('/')}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    writer = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, rows: int = 512) -> DataFrame:
    """*df*, with a session that hands Python workers few whole texts at a time, to bound their memory."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, str(rows))
    return df


def light_batches(df: DataFrame, size: int = 8 << 20) -> DataFrame:
    """*df*, with a session that hands Python workers about *size* bytes at a time, for rows that differ in size or are large."""
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > size:
        spark.conf.set(name, f"{size}b")
    return df


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text is divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Memo(dict):
    """A cache of a function of one argument that holds between one and two times *size* values at most.

    When it is full, its values become the older generation, and those asked for again come back from it,
    so that frequent arguments stay and rare ones go.
    """

    def __init__(self, function, size: int = 50_000):
        super().__init__()
        self.function, self.size, self.older = function, size, {}

    def __missing__(self, key):
        value = self.older.pop(key) if key in self.older else self.function(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def sorted_groups(
    batches: Iterable[pd.DataFrame], keys: Sequence[str]
) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The groups of a partition that is sorted by *keys*; only one group is held at a time."""
    held: list[pd.DataFrame] = []
    current = None
    for batch in batches:
        if batch.empty:
            continue
        values = batch[list(keys)].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            key = tuple(values[start])
            if held and key != current:
                yield current, pd.concat(held, ignore_index=True)
                held = []
            current = key
            held.append(batch.iloc[start:end])
    if held:
        yield current, pd.concat(held, ignore_index=True)


class Forest:
    """Union of small numbers, for the rows of one task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether x and y were apart until now."""
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): node, component (the smallest node reachable).

    Large-star and small-star steps alternate until nothing changes: every step is a grouped minimum,
    combined before its shuffle, and a join that adaptive execution may split. Only nodes with an edge
    to another node are returned. Two numbers per round reach the driver.
    """
    stars = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "edges",
    )
    seen = None
    while True:
        mark = stars.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
                stars.select("lo", "lo").distinct()
            )
        seen = mark
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(stars.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        stars = stage(small.union(lowest.select("hi", "m")).distinct(), "stars")
