"""Fact rows: resolving dimension keys, numbering the facts, and comparing them with other ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.operators.keys import assign_batch_keys, assign_keys, count_cells
from lodeworks.sources.tables import stage, stage_in_turn

_SHARES = 64


@dataclass(frozen=True)
class Lookup:
    """How facts find a dimension key: *keys* has one row per value of *on*, which facts share."""

    keys: DataFrame
    on: tuple[str, ...]


def resolve_keys(events: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Add the key column of every lookup; rows without a match stay, with a null key.

    No join is hinted: staged and written dimensions have known sizes, so small ones are broadcast
    and large ones are merge-joined, where adaptive execution splits hot keys.
    """
    for lookup in lookups:
        events = events.join(lookup.keys, list(lookup.on), "left")
    return events


def _broadcast(lookup: Lookup) -> bool:
    """Whether Spark will broadcast the keys, by their known size."""
    spark = lookup.keys.sparkSession
    size = int(str(lookup.keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def load_facts(
    events: DataFrame,
    lookups: Sequence[Lookup],
    surrogate_key: str,
    columns: Sequence[str],
    order: Sequence[str | Column],
    start: int = 0,
) -> DataFrame:
    """One fact per event: resolve all keys, keep *columns*, number from ``start + 1`` in *order*.

    The *order* is one of event columns. Events are numbered before they are joined, so the pass that finds the ranges
    repeats no join, and the joins shuffle no order columns.
    """
    found = {name for lookup in lookups for name in lookup.keys.columns if name not in lookup.on}
    needed = [*(name for name in columns if name not in found), *(name for lookup in lookups for name in lookup.on)]
    numbered = assign_keys(events, surrogate_key, order, start, list(dict.fromkeys(needed)))
    return resolve_keys(numbered, lookups).select(surrogate_key, *columns)


def fact_history(
    events: DataFrame,
    lookups: Sequence[Lookup],
    surrogate_key: str,
    columns: Sequence[str],
    row_hash: Column,
    batch: str = "edition_seq",
    start: int = 0,
    counts: Mapping[tuple[int, int], int] | None = None,
) -> DataFrame:
    """Facts of all batches at once, numbered batch by batch.

    Lookups into versioned dimensions use the batch number beside the natural key, so each fact
    gets the version that was current when its batch was loaded. Facts are numbered by the *row_hash*
    of their events; *counts* is its histogram by batch and cell, which is taken here if not given.

    Joins that shuffle the facts are staged one by one, after those with broadcast tables, so the disk holds one such shuffle
    at a time, and not all of them with that of the numbering.
    """
    if counts is None:
        counts = count_cells(events, batch, row_hash)
    large = [lookup for lookup in lookups if not _broadcast(lookup)]
    facts = resolve_keys(events.withColumn("_hash", row_hash), [lookup for lookup in lookups if _broadcast(lookup)])

    def join(place: int):
        later = [name for lookup in large[place:] for name in lookup.on]

        def step(rows: DataFrame) -> DataFrame:
            needed = dict.fromkeys([*columns, batch, "_hash", *later])
            return resolve_keys(rows.select(*(name for name in needed if name in rows.columns)), [large[place]])

        return step

    facts = stage_in_turn(facts, "facts", [join(place) for place in range(len(large))])
    return assign_batch_keys(facts, surrogate_key, batch, counts, F.col("_hash"), start, columns)


def multiset_difference(
    before: DataFrame, after: DataFrame, key: str, same: Sequence[str], carried: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """What makes the rows *before* into those *after*: the rows to add, and the *key* of those to take back.

    Rows are alike if all columns *same* are, nulls included; alike rows are counted, so that one of two can be
    taken back. Added rows also have the *carried* columns, by their largest values among alike rows.

    Counts are combined before their shuffle, so however many alike rows there are, they make one row a task.
    Which of them are taken back is settled by share of the keys: each share gives as many rows as it has until
    the surplus is reached, and numbers its own rows only.
    """
    types = {field.name: field.dataType for field in after.schema}
    empty = [F.lit(None).cast(types[name]).alias(name) for name in carried]
    sides = before.select(*same, *empty, F.lit(-1).alias("_sign")).union(after.select(*same, *carried, F.lit(1)))
    counted = sides.groupBy(*same).agg(F.sum("_sign").alias("_n"), *(F.max(name).alias(name) for name in carried))
    differing = stage(
        counted.filter("_n <> 0").withColumn("_group", F.monotonically_increasing_id()), "differing-rows"
    )
    more = differing.filter("_n > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    added = more.select(*same, *carried)

    surplus = differing.filter("_n < 0").select(*(F.col(name).alias(f"_is_{name}") for name in same), "_group", (-F.col("_n")).alias("_surplus"))
    alike = [F.col(name).eqNullSafe(F.col(f"_is_{name}")) for name in same]
    rows = stage(
        before.join(surplus, alike).select("_group", "_surplus", F.pmod(F.xxhash64(key), F.lit(_SHARES)).alias("_share"), key), "surplus-rows"
    )
    shares = rows.groupBy("_group", "_surplus", "_share").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = F.coalesce(F.sum("_rows").over(Window.partitionBy("_group").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = stage(
        shares.withColumn("_quota", F.least(F.col("_rows"), F.col("_surplus") - earlier)).filter("_quota > 0").select("_group", "_share", "_quota"),
        "surplus-shares",
    )
    place = F.row_number().over(Window.partitionBy("_group", "_share").orderBy(key))
    taken = rows.join(quota, ["_group", "_share"]).withColumn("_place", place).filter("_place <= _quota")
    return added, taken.select(key)
