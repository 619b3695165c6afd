"""Slowly changing dimensions.

One batch after another is a fold, but only per natural key. All batches are therefore handled
at once: the rows of a key are brought together in batch order, after each batch has been reduced
to one row per key, so no key ever has more rows than there are batches. A single batch
(``*_merge``) is the same computation with one batch.

*snapshots* hold one row per natural key and batch, with an integer batch number from 1 upwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.functions.columns import changed_expr, current
from lodeworks.operators.keys import assign_keys, max_key
from lodeworks.sources.tables import stage

OPEN_END = date(9999, 12, 31)  # fixed value: valid_to of an open version
VERSION_COLUMNS = ("valid_from", "valid_to", "is_current")

_BATCH = "edition_seq"
_DATE = "load_date"


@dataclass(frozen=True)
class Scd2Result:
    """The outcome of type 2 batches.

    *closed* are the versions that were closed before, *kept* those that were open and stay open, and
    *changed* all others: new ones, and those closed now. *bindings* tell which version was current
    for each natural key and batch.
    """

    closed: DataFrame | None
    kept: DataFrame | None
    changed: DataFrame
    bindings: DataFrame | None

    @property
    def dimension(self) -> DataFrame:
        return _union([self.closed, self.kept, self.changed])


def _valid_row(natural_key: str, by_key) -> Column:
    """Always true; fails the job on null natural keys and on keys repeated within a batch."""
    repeated = (F.col("_seq") >= 0) & (F.col("_seq") == F.lag("_seq").over(by_key))
    return (
        F.when(
            F.col(natural_key).isNull(),
            F.raise_error(F.lit(f"null natural key in {natural_key}")).cast("boolean"),
        )
        .when(
            repeated,
            F.raise_error(F.lit(f"duplicate natural key in one batch: {natural_key}")).cast("boolean"),
        )
        .otherwise(True)
    )


def _union(parts: Sequence[DataFrame | None]) -> DataFrame:
    frames = [part for part in parts if part is not None]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


# --- type 0: insert only -------------------------------------------------------------------------


def scd0_history(
    snapshots: DataFrame,
    natural_key: str,
    surrogate_key: str,
    existing: DataFrame | None = None,
    batch: str = _BATCH,
) -> DataFrame:
    """Keep the first snapshot of each natural key; keys that already exist are never updated."""
    return _union([existing, scd0_additions(snapshots, natural_key, surrogate_key, existing, batch)])


def scd0_additions(
    snapshots: DataFrame,
    natural_key: str,
    surrogate_key: str,
    existing: DataFrame | None = None,
    batch: str = _BATCH,
) -> DataFrame:
    """The rows that the snapshots add to a type 0 dimension."""
    rows = snapshots.withColumnRenamed(batch, "_seq")
    by_key = Window.partitionBy(natural_key).orderBy("_seq")
    fresh = (
        rows.withColumns(
            {"_valid": _valid_row(natural_key, by_key), "_rank": F.row_number().over(by_key)}
        )
        .filter(F.col("_valid") & (F.col("_rank") == 1))
        .drop("_valid", "_rank")
    )
    if existing is not None:
        fresh = fresh.join(existing.select(natural_key), natural_key, "left_anti")
    columns = [name for name in fresh.columns if name != "_seq"]
    start = max_key(existing, surrogate_key)
    return assign_keys(fresh, surrogate_key, ["_seq", natural_key], start, columns)


def scd0_merge(
    existing: DataFrame | None, incoming: DataFrame, natural_key: str, surrogate_key: str
) -> DataFrame:
    """Add the unseen natural keys of one batch."""
    batch = incoming.withColumn(_BATCH, F.lit(1))
    return scd0_history(batch, natural_key, surrogate_key, existing)


# --- type 1: overwrite ---------------------------------------------------------------------------


def scd1_history(
    snapshots: DataFrame,
    natural_key: str,
    tracked: Sequence[str],
    surrogate_key: str | None = None,
    existing: DataFrame | None = None,
    batch: str = _BATCH,
) -> DataFrame:
    """Overwrite tracked columns with the latest snapshot (also with null) and append new keys.

    Other columns keep the value from the first appearance. A tracked column that the snapshots
    lack is left alone. New keys are numbered by first appearance, then natural key.
    """
    unchanged, changed = scd1_changes(snapshots, natural_key, tracked, surrogate_key, existing, batch)
    return _union([unchanged, changed])


def scd1_changes(
    snapshots: DataFrame,
    natural_key: str,
    tracked: Sequence[str],
    surrogate_key: str | None = None,
    existing: DataFrame | None = None,
    batch: str = _BATCH,
    last_key: int | None = None,
) -> tuple[DataFrame | None, DataFrame]:
    """The existing rows that stay as they are, and the new and overwritten ones.

    New keys follow *last_key*, by default the largest one among the existing rows.
    """
    incoming = snapshots.withColumnRenamed(batch, "_seq")
    overwritten = [name for name in tracked if name in incoming.columns]
    before = None if existing is None else existing.withColumn("_seq", F.lit(0))
    rows = _union([before, incoming])

    by_key = Window.partitionBy(natural_key).orderBy("_seq")
    whole_key = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct(*overwritten) if overwritten else F.lit(None)
    merged = (
        rows.withColumns(
            {
                "_valid": _valid_row(natural_key, by_key),
                "_rank": F.row_number().over(by_key),
                "_latest": F.last(own).over(whole_key) if overwritten else own,
            }
        )
        .filter(F.col("_valid") & (F.col("_rank") == 1))
        .withColumn("_changed", (F.col("_seq") > 0) | ~own.eqNullSafe(F.col("_latest")))
        .withColumns({name: F.col(f"_latest.{name}") for name in overwritten})
        .drop("_valid", "_rank", "_latest")
    )
    columns = [name for name in merged.columns if name not in ("_seq", "_changed", surrogate_key)]
    if surrogate_key is None:
        if existing is None:
            return None, merged.select(columns)
        return merged.filter(~F.col("_changed")).select(columns), merged.filter("_changed").select(columns)

    order = ["_seq", natural_key]
    # Ranges are found by an extra pass, which should not repeat the windows.
    merged = stage(merged, "scd1")
    if existing is None:
        return None, assign_keys(merged, surrogate_key, order, 0, columns)
    missing = F.col(surrogate_key).isNull()
    start = max_key(existing, surrogate_key) if last_key is None else last_key
    keyed = assign_keys(merged.filter(missing), surrogate_key, order, start, columns)
    known = merged.filter(~missing)
    overwritten_rows = known.filter("_changed").drop("_seq", "_changed")
    return known.filter(~F.col("_changed")).drop("_seq", "_changed"), _union([overwritten_rows, keyed])


def scd1_merge(
    existing: DataFrame | None,
    incoming: DataFrame,
    natural_key: str,
    tracked: Sequence[str],
    surrogate_key: str | None = None,
) -> DataFrame:
    """Apply one batch: overwrite the tracked columns of known keys and append unknown keys."""
    batch = incoming.withColumn(_BATCH, F.lit(1))
    return scd1_history(batch, natural_key, tracked, surrogate_key, existing)


# --- type 2: versions ----------------------------------------------------------------------------


def _flag_versions(
    rows: DataFrame, natural_key: str, tracked: Sequence[str], has_existing: bool
) -> DataFrame:
    """Mark the rows that start a version, number the versions per key, and close each version.

    Comparing with the previous row equals comparing with the current version, because a row that
    starts no version is equal (as text) to the version it belongs to.
    """
    by_key = Window.partitionBy(natural_key).orderBy("_seq")
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = (
        Window.partitionBy(natural_key)
        .orderBy(F.col("_seq").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.lag("_seq").over(by_key).isNull()
    if has_existing:
        first = first | (F.lag("_seq").over(by_key) < 0)
    differs = changed_expr((F.lag(name).over(by_key), F.col(name)) for name in tracked)

    flagged = rows.withColumns(
        {"_valid": _valid_row(natural_key, by_key), "_new": first, "_starts": first | differs}
    ).filter(F.col("_valid"))
    if has_existing:
        # A key that has only closed versions stays closed: its marker row (-1) precedes every
        # incoming row and no open version (0) does.
        seen_closed = F.bool_or(F.col("_seq") == -1).over(so_far)
        seen_open = F.bool_or(F.col("_seq") == 0).over(so_far)
        flagged = flagged.withColumn("_alive", ~seen_closed | seen_open)
        flagged = flagged.filter(F.col("_alive") & (F.col("_seq") >= 0)).drop("_alive")
    flagged = flagged.withColumn("_version", F.count_if(F.col("_starts")).over(so_far))
    next_start = F.last(F.when(F.col("_starts"), F.col("_date")), ignorenulls=True).over(later)
    return flagged.withColumns(
        {
            "valid_to": F.coalesce(next_start, F.lit(OPEN_END)),
            "is_current": next_start.isNull(),
        }
    ).drop("_valid")


def scd2_versions(
    snapshots: DataFrame,
    natural_key: str,
    tracked: Sequence[str],
    surrogate_key: str,
    existing: DataFrame | None = None,
    batch: str = _BATCH,
    load_date: str = _DATE,
    bind: bool = True,
    always_open: bool = False,
    last_key: int | None = None,
) -> Scd2Result:
    """Versions over all batches, on top of an existing dimension if there is one.

    A version starts when a tracked column differs from the current version, and ends where the
    next one starts (half-open). Keys missing from a batch stay open. Surrogate keys follow the
    batches: in each, changed keys first, then new ones, by natural key.

    With *bind*, also returns the surrogate key that was current for each (natural key, batch).
    A key that has only closed versions stays closed. With *always_open* there are no such keys (no
    merge makes them), and the keys of closed versions need not be brought together with the rest.
    New surrogate keys follow *last_key*, by default the largest one among the existing versions.
    """
    missing = [name for name in tracked if name not in snapshots.columns]
    if missing:
        raise ValueError(f"tracked columns missing from the snapshots: {missing}")
    names = [name for name in snapshots.columns if name not in (batch, load_date)]
    rows = snapshots.select(
        *names, F.col(batch).alias("_seq"), F.col(load_date).cast("date").alias("_date")
    )

    closed = None
    if existing is not None:
        closed = existing.filter(~F.col("is_current"))
        opened = (
            current(existing)
            .withColumns({"_seq": F.lit(0), "_date": F.col("valid_from")})
            .drop(*VERSION_COLUMNS)
        )
        # One marker row brings the key of closed versions along, and nothing else of them.
        markers = closed.select(natural_key).distinct().withColumn("_seq", F.lit(-1))
        rows = _union([rows, opened, None if always_open else markers])

    flagged = _flag_versions(rows, natural_key, tracked, existing is not None)
    if bind or existing is not None:
        # Rows that start no version are kept for their binding only.
        values = [name for name in flagged.columns if name != natural_key and name[0] != "_"]
        starts = F.col("_starts")
        flagged = flagged.withColumns({name: F.when(starts, F.col(name)) for name in values})
        flagged = stage(flagged, surrogate_key)

    attributes = [name for name in flagged.columns if not name.startswith("_")]
    attributes = [name for name in attributes if name not in (surrogate_key, *VERSION_COLUMNS)]
    columns = [*attributes, "valid_from", "valid_to", "is_current", "_version"]
    started = flagged.filter(F.col("_starts")).withColumn("valid_from", F.col("_date"))
    kept = None
    if existing is not None:
        kept = started.filter(F.col("_seq") == 0).select(surrogate_key, *columns)
        started = started.filter(F.col("_seq") > 0)
    start = max_key(existing, surrogate_key) if last_key is None else last_key
    fresh = assign_keys(started, surrogate_key, ["_seq", "_new", natural_key], start, columns)
    versions = _union([kept, fresh])
    changed = fresh
    if existing is not None:
        changed = _union([kept.filter(~F.col("is_current")), fresh])
        kept = kept.filter("is_current").drop("_version")

    bindings = None
    if bind:
        bindings = (
            flagged.filter(F.col("_seq") > 0)
            .select(natural_key, F.col("_seq").alias(batch), "_version")
            .join(versions.select(natural_key, "_version", surrogate_key), [natural_key, "_version"])
            .drop("_version")
        )
    return Scd2Result(closed, kept, changed.drop("_version"), bindings)


def scd2_history(
    snapshots: DataFrame,
    natural_key: str,
    tracked: Sequence[str],
    surrogate_key: str,
    existing: DataFrame | None = None,
    batch: str = _BATCH,
    load_date: str = _DATE,
) -> DataFrame:
    """The dimension of :func:`scd2_versions`."""
    return scd2_versions(
        snapshots, natural_key, tracked, surrogate_key, existing, batch, load_date, bind=False
    ).dimension


def scd2_merge(
    existing: DataFrame | None,
    incoming: DataFrame,
    natural_key: str,
    tracked: Sequence[str],
    surrogate_key: str,
    load_date: date,
) -> DataFrame:
    """Apply one batch: expire changed versions, add their successors, add unseen keys."""
    batch = incoming.withColumns({_BATCH: F.lit(1), _DATE: F.lit(load_date)})
    return scd2_history(batch, natural_key, tracked, surrogate_key, existing)


def classify_changes(
    existing: DataFrame, incoming: DataFrame, natural_key: str, tracked: Sequence[str]
) -> DataFrame:
    """Per incoming key: ``new``, ``changed``, ``unchanged``, or ``closed`` (only expired versions)."""
    known = existing.groupBy(natural_key).agg(
        F.max(F.struct("is_current", F.struct(*tracked).alias("old"))).alias("_known")
    )
    differs = changed_expr((F.col(f"_known.old.{name}"), F.col(name)) for name in tracked)
    change = (
        F.when(F.col("_known").isNull(), "new")
        .when(~F.col("_known.is_current"), "closed")
        .when(differs, "changed")
        .otherwise("unchanged")
    )
    return incoming.join(known, natural_key, "left").select(natural_key, change.alias("change"))


def as_of(dimension: DataFrame, day: date | Column) -> DataFrame:
    """The versions that were valid on a day."""
    moment = day if isinstance(day, Column) else F.lit(day)
    return dimension.filter((F.col("valid_from") <= moment) & (moment < F.col("valid_to")))


def as_of_sliced(
    rows: DataFrame, dimension: DataFrame, natural_key: str, day: str, slice_days: int = 366, slice_rows: int = 1_000_000
) -> DataFrame:
    """Each row with the columns of the version of its key that was valid on its *day*; rows without one are left out.

    The result is that of a join on the key, filtered by as_of(), without its work of rows times versions: rows and
    versions of a key are sorted together, and the last version is carried forward. Versions of a key must not overlap.

    A key with very many rows is cut into slices of *slice_days* days, and a slice of more than *slice_rows* rows into
    shares. Every slice and share gets the versions that start within it and the one that is valid at its
    start, so all versions together are repeated at most once per slice and share.
    """
    number = F.floor(F.unix_date(F.col("_day")) / slice_days)
    kept = [name for name in dimension.columns if name != natural_key]
    dated = rows.filter(F.col(natural_key).isNotNull() & F.col(day).isNotNull()).withColumn("_day", F.col(day).cast("date"))
    sliced = dated.withColumn("_slice", number)
    sizes = sliced.groupBy(natural_key, "_slice").agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("int").alias("_shares"))
    sizes = stage(sizes, "slices")

    # Copies of a row are told apart by where they are read.
    spot = F.pmod(F.xxhash64(*(name for name in rows.columns)) + F.spark_partition_id(), F.col("_shares"))
    spread = sliced.join(sizes.filter("_shares > 1"), [natural_key, "_slice"], "left").withColumn("_share", F.coalesce(spot, F.lit(0)))

    spans = sizes.groupBy(natural_key).agg(F.min("_slice").alias("_first"), F.max("_slice").alias("_last"))
    valid = dimension.filter("valid_from < valid_to").join(spans, natural_key)
    from_slice = F.floor(F.unix_date("valid_from") / slice_days)
    to_slice = F.floor((F.unix_date("valid_to") - 1) / slice_days)
    start, end = F.greatest("_first", from_slice), F.least("_last", to_slice)
    handed = (
        valid.filter(start <= end)
        .withColumn("_slice", F.explode(F.sequence(start, end)))
        .join(sizes, [natural_key, "_slice"])
        .withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_shares").cast("long") - 1)))
        .select(natural_key, "_slice", "_share", F.col("valid_from").alias("_day"), F.struct(*kept).alias("_version"))
    )
    asked = spread.select(natural_key, "_slice", "_share", "_day", F.struct(*rows.columns).alias("_row"))
    both = handed.unionByName(asked, allowMissingColumns=True)
    order = ["_day", F.col("_row").isNotNull()]
    so_far = Window.partitionBy(natural_key, "_slice", "_share").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
    found = carried.filter(F.col("_row").isNotNull() & (F.col("_day") < F.col("_version.valid_to")))
    return found.select("_row.*", "_version.*")
