"""Removing repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.sources.tables import stage


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Keep one of each group of identical rows (nulls are equal, NaNs are equal).

    Copies are collapsed inside each map task before the shuffle, so a row that makes up a large
    share of the table does not load one task.
    """
    return df.dropDuplicates()


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Keep, for each key, the first row in the given order. The order should be total per key.

    Spark evaluates ``row_number() = 1`` with a group limit before the shuffle: every map task
    sends at most one row per key, which keeps hot keys small.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keep_first_of_few(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], least: DataFrame | None = None
) -> DataFrame:
    """keep_first() where few keys have many rows: only rows that can come first are sorted.

    These are the ones with the least value, or none, in the first column of the order. That value, by key as
    ``_least``, is looked for here unless given.
    """
    lead = order[0]
    if least is None:
        least = stage(df.groupBy(*keys).agg(F.min(lead).alias("_least")), "least")
    least = least.select(*(F.col(key).alias(f"_is_{key}") for key in keys), "_least")
    alike = [F.col(key).eqNullSafe(F.col(f"_is_{key}")) for key in keys]
    first = F.col(lead).isNull() | (F.col(lead) <= F.col("_least"))
    return keep_first(df.join(least, alike).filter(first).select(df.columns), keys, order)
