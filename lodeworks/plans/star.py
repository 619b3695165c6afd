"""Silver to gold: loading a star schema, and the whole run from raw files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from lodeworks.functions.columns import (
    current,
    edition_order_key,
    load_date_of,
    require_columns,
)
from lodeworks.operators.dedupe import keep_first, keep_first_of_few
from lodeworks.operators.facts import Lookup, fact_history, load_facts, multiset_difference, resolve_keys
from lodeworks.operators.keys import assign_keys, hash_cell, max_key
from lodeworks.operators.lineage import Step, log_steps, read_lineage, utc_now
from lodeworks.operators.quality import enforce_constraints
from lodeworks.operators.scd import (
    classify_changes,
    scd0_additions,
    scd1_changes,
    scd2_versions,
)
from lodeworks.plans.cleaning import (
    EVENT_CLEANING,
    REGION_CLEANING,
    SILVER_EVENT_RULES,
    SILVER_REGION_RULES,
    clean_to_silver,
)
from lodeworks.plans.specs import RESULTS_STAR, DimensionSpec, StarSpec
from lodeworks.plans.splice import (
    TAKEN_BACK,
    Spliced,
    read_facts,
    rebind,
    rebound_table,
    splice_overwrites,
    splice_versions,
)
from lodeworks.schemas import PIPELINE_LINEAGE, conform
from lodeworks.sources.gold import NO_LOADS, Gold, Loads, Merged
from lodeworks.sources.tables import append_rows, freed_after, ingest_csv, stage

T = TypeVar("T")
R = TypeVar("R")

_BATCH = "edition_seq"
_DATE = "load_date"
_CELL = "_cell"
_LEAST = "_least"
_LOADED = "editions_loaded"
_LOADED_SCHEMA = StructType(
    [
        StructField("edition", StringType()),
        StructField("row_count", LongType()),
        StructField("content", DecimalType(38, 0)),
        StructField(_DATE, DateType()),
    ]
)


class LateEditionError(Exception):
    """An edition is older than one already loaded; history can only be rebuilt, not inserted."""


class ChangedEditionError(Exception):
    """A loaded edition has other rows than those that were loaded."""


def _used_columns(events: DataFrame, spec: StarSpec) -> list[str]:
    """The columns of the events that the star uses."""
    used = {spec.edition, spec.year, *spec.fact.measures, *spec.fact.order}
    for dim in spec.dimensions:
        if dim.source == "events":
            used.update([*dim.columns, *dim.order])
    return [name for name in sorted(used) if name in events.columns]


def _row_hash(events: DataFrame, spec: StarSpec, content: Column) -> Column:
    """The hash by which facts are numbered. It covers all columns of the events, so that events
    which give equal facts are still dealt out evenly: those that the star uses by their *content* hash."""
    used = {*_used_columns(events, spec), _BATCH, _DATE}
    return F.xxhash64(content, *(name for name in sorted(events.columns) if name not in used))


def edition_cells(events: DataFrame, spec: StarSpec) -> DataFrame:
    """Per edition and cell of row hashes: first year, row count and content, the sum of content hashes.

    If the dimension of the editions has an order, ``_least`` is the least value of its first column. The content hash covers the columns that the star uses. Sums do not depend on the order of rows, and
    those of several loads of an edition add up. The cells are the histogram by which facts are numbered.
    """
    hashed = events.withColumn("_content", F.xxhash64(*_used_columns(events, spec)))
    row_hash = F.col("_content")
    cell = hash_cell(_row_hash(events, spec, row_hash))
    edition = spec.dimension(spec.edition_dimension)
    lead = edition.order[:1] if edition.source_key == spec.edition else ()
    # The halves of the hashes are added up as longs, which is cheaper than decimals for every row.
    sums = hashed.groupBy(spec.edition, cell.alias(_CELL)).agg(
        F.min(spec.year).alias("_year"),
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.shiftright(row_hash, 32)).alias("_high"),
        F.sum(row_hash.bitwiseAND(F.lit(0xFFFFFFFF))).alias("_low"),
        *(F.min(name).alias(_LEAST) for name in lead),
    )
    high = F.col("_high").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)")
    content = (high + F.col("_low")).cast("decimal(38,0)")
    return sums.select(spec.edition, _CELL, "_year", "row_count", content.alias("content"), *([_LEAST] if lead else []))


def edition_contents(cells: DataFrame, spec: StarSpec) -> DataFrame:
    """The sums of edition_cells() per edition."""
    return cells.groupBy(spec.edition).agg(
        F.min("_year").alias("_year"),
        F.sum("row_count").alias("row_count"),
        F.sum("content").alias("content"),
    )


def _in_order(found: DataFrame, spec: StarSpec) -> DataFrame:
    dated = found.withColumns(
        {"order_key": edition_order_key(F.col(spec.edition)), _DATE: load_date_of(F.col("_year"))}
    ).drop("_year")
    return assign_keys(dated, _BATCH, ["order_key", spec.edition])


def list_editions(
    events: DataFrame, spec: StarSpec, loaded: DataFrame | None = None
) -> DataFrame:
    """The editions in chronological order (by leading number of the label, then by label).

    One row per edition that is not among the *loaded* ones: label, batch number from 1, load date
    (January 1 of its first year), row count.
    """
    found = edition_contents(edition_cells(events, spec), spec).drop("content")
    if loaded is not None:
        found = found.join(loaded, spec.edition, "left_anti")
    return _in_order(found, spec)


def dimension_snapshots(
    rows: DataFrame, dim: DimensionSpec, few: bool = False, least: DataFrame | None = None
) -> DataFrame:
    """One row per natural key and batch, with gold column names; *few* tells that all keys fit into memory.

    *least* is what keep_first_of_few() takes.
    """
    kept = [*dim.columns, _BATCH, _DATE]
    keys = [dim.source_key, _BATCH]
    if dim.order and few:
        first = keep_first_of_few(rows.select(*dict.fromkeys([*kept, *dim.order])), keys, dim.order, least)
    elif dim.order:
        first = keep_first(rows.select(*dict.fromkeys([*kept, *dim.order])), keys, dim.order)
    else:
        # Rows that agree on the dimension's columns are interchangeable, so they are collapsed by
        # hash aggregation before anything is sorted.
        others = [name for name in dim.columns if name != dim.source_key]
        first = keep_first(rows.select(*kept).distinct(), keys, others or keys)
    return first.select(*(F.col(name).alias(gold) for name, gold in dim.columns.items()), _BATCH, _DATE)


def merged_table(dim: DimensionSpec) -> Merged:
    """How a dimension of type 1 or 2 is stored: deltas by surrogate key."""
    partition_by = ("is_current",) if dim.scd_type == 2 else ()
    return Merged(dim.table, dim.schema, dim.surrogate_key, partition_by)


def read_dimension(gold: Gold, dim: DimensionSpec, loads: Loads | None = None) -> DataFrame:
    """The published rows of a dimension, or those of the given loads."""
    if dim.scd_type == 0:
        return gold.read_all(dim.table, dim.schema, loads)
    return gold.read_merged(merged_table(dim), loads)


def compact(gold: Gold, spec: StarSpec = RESULTS_STAR) -> int | None:
    """Write the dimensions that are stored as deltas anew; returns the load, or nothing if there is one only."""
    return gold.compact([merged_table(dim) for dim in spec.dimensions if dim.scd_type != 0])


def remove_superseded(gold: Gold, spec: StarSpec = RESULTS_STAR) -> list[str]:
    """Delete what no reader of the published tables needs: see Gold.remove_superseded()."""
    added = [dim.table for dim in spec.dimensions if dim.scd_type == 0]
    merged = [merged_table(dim) for dim in spec.dimensions if dim.scd_type != 0]
    return gold.remove_superseded([*added, spec.fact.table, _LOADED], merged, [rebound_table(spec.fact)])


def load_dimension(
    snapshots: DataFrame, dim: DimensionSpec, existing: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """The rows that a load has to write: new ones, and those that it changes.

    For type 2 also the (key, batch) bindings. Only the existing rows of the snapshots' keys take part.
    """
    nk, sk = dim.natural_key, dim.surrogate_key
    if dim.scd_type == 0:
        return scd0_additions(snapshots.drop(_DATE), nk, sk, existing), None
    last_key = None
    if existing is not None:
        snapshots = stage(snapshots, f"{dim.table}-snapshots")
        last_key = max_key(existing, sk)
        existing = existing.join(snapshots.select(nk).distinct(), nk, "left_semi")
    if dim.scd_type == 1:
        _, changed = scd1_changes(
            snapshots.drop(_DATE), nk, dim.tracked, sk, existing, last_key=last_key
        )
        return changed, None
    bind = dim.source == "events"
    result = scd2_versions(
        snapshots, nk, dim.tracked, sk, existing, bind=bind, always_open=True, last_key=last_key
    )
    return result.changed, result.bindings


def _lookup(dim: DimensionSpec, rows: DataFrame, bindings: DataFrame | None) -> Lookup:
    """How facts find a dimension's keys: by the bindings, or among the *rows* of the dimension."""
    key = F.col(dim.natural_key).alias(dim.source_key)
    if bindings is not None:
        keys = stage(bindings.select(key, _BATCH, dim.surrogate_key), f"{dim.table}-bindings")
        return Lookup(keys, (dim.source_key, _BATCH))
    rows = current(rows) if dim.scd_type == 2 else rows
    return Lookup(rows.select(key, dim.surrogate_key), (dim.source_key,))


def _all_at_once(spark: SparkSession, task: Callable[[T], R], items: Sequence[T]) -> list[R]:
    """Run independent loads side by side, so that small jobs fill the gaps of large ones."""
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(task), items))


@dataclass(frozen=True)
class Batches:
    """Events that carry ``edition_seq`` and ``load_date``, the date of the first batch.

    *counts* are the numbers of rows by batch and cell, *contents* the row counts and content sums of the
    editions, as far as the batches hold them. If they go before loaded editions, *places* has edition,
    edition_seq and load_date of the loaded ones, in one order with these. With *corrected* the batches are
    loaded editions that have other rows now: edition and edition_seq of each; *places* lacks them then.
    *least* has, by edition and edition_seq, the least value of the first order column of the dimension of the editions.
    """

    events: DataFrame
    first_date: date
    counts: Mapping[tuple[int, int], int]
    contents: DataFrame
    places: DataFrame | None = None
    corrected: DataFrame | None = None
    least: DataFrame | None = None


def load_star(
    gold: Gold,
    spec: StarSpec,
    batches: Batches,
    regions: DataFrame,
    log: Callable[[], None],
    rebuild: bool = False,
    arrival: str | None = None,
) -> None:
    """Load batches of events, *log* them, and publish them, if given with the *arrival* they came with.

    All batches go through each table together; every table is written once. The regions are one
    full snapshot, dated by the first batch. No load is visible without its lineage.
    """
    published = gold.loads()
    loads = NO_LOADS if rebuild else published
    load_id = 1 if published.last is None else published.last["load_id"] + 1
    events = batches.events
    regions = regions.withColumns({_BATCH: F.lit(1), _DATE: F.lit(batches.first_date)})

    rebound: dict[str, DataFrame] = {}

    def load(dim: DimensionSpec) -> Spliced:
        existing = read_dimension(gold, dim, loads) if loads.last else None
        rows = events if dim.source == "events" else regions
        few = dim.table == spec.edition_dimension
        snapshots = dimension_snapshots(rows, dim, few, batches.least if few else None)
        if batches.places is None or dim.source != "events" or dim.scd_type == 0:
            return Spliced(*load_dimension(snapshots, dim, existing))
        edition = spec.dimension(spec.edition_dimension)
        labels = read_dimension(gold, edition, loads).select(
            F.col(edition.surrogate_key).alias("edition_sk"), F.col(edition.natural_key).alias(spec.edition)
        )
        places = labels.join(batches.places, spec.edition).drop(spec.edition)
        corrected = None
        if batches.corrected is not None:
            corrected = labels.join(batches.corrected, spec.edition).drop(spec.edition)
        own = F.col(edition.surrogate_key).alias("edition_sk")
        facts = read_facts(gold, spec.fact, loads).select(own, dim.surrogate_key)
        if dim.scd_type == 2:
            return splice_versions(snapshots, dim, existing, facts, places, corrected)
        return splice_overwrites(snapshots, dim, existing, facts, places)

    def write_dimension(dim: DimensionSpec) -> Lookup:
        spliced = load(dim)
        table, bindings = spliced.changed, spliced.bindings
        if spliced.rebound is not None:
            rebound[dim.surrogate_key] = spliced.rebound
        if dim.scd_type == 0:
            written = gold.write_snapshot(dim.table, conform(table, dim.schema), load_id)
        else:
            written = gold.write_delta(merged_table(dim), conform(table, dim.schema), load_id)
        # Surrogate keys are dense by construction; natural keys come from outside.
        opened = current(written) if dim.scd_type == 2 else written
        enforce_constraints(opened, dim.table, primary_key=[dim.natural_key])
        return _lookup(dim, read_dimension(gold, dim, loads.then(load_id)), bindings)

    lookups = _all_at_once(gold.spark, write_dimension, spec.dimensions)
    start = loads.last["last_fact_key"] if loads.last else 0
    taken_back = None
    if batches.corrected is None:
        facts = _number_facts(spec, batches, lookups, start)
    else:
        facts, taken_back = _correct_facts(gold, spec, batches, lookups, loads, load_id, start)
    # Keys are dense and continue from the last one, so they need no uniqueness check.
    written = gold.write_snapshot(spec.fact.table, conform(facts, spec.fact.schema), load_id, spec.fact.partition_by)
    gold.write_snapshot(_LOADED, conform(batches.contents, _LOADED_SCHEMA), load_id)
    again = []
    if rebound:
        edition_key = spec.dimension(spec.edition_dimension).surrogate_key
        moved = rebind(read_facts(gold, spec.fact, loads), spec.fact, edition_key, rebound)
        again.append(moved.withColumn(TAKEN_BACK, F.lit(False)))
    if taken_back is not None:
        again.append(taken_back.withColumn(TAKEN_BACK, F.lit(True)))
    if again:
        table = rebound_table(spec.fact)
        gold.write_delta(table, conform(reduce(DataFrame.unionByName, again), table.schema), load_id)
    log()
    last_key = start + sum(batches.counts.values())
    if batches.corrected is not None:
        last_key = max(start, max_key(written, spec.fact.surrogate_key))
    gold.publish(load_id, rebuild or published.last is None, last_key, rebound=bool(again), arrival=arrival)


def _correct_facts(
    gold: Gold, spec: StarSpec, batches: Batches, lookups: Sequence[Lookup], loads: Loads, load_id: int, start: int
) -> tuple[DataFrame, DataFrame]:
    """The facts that corrected editions have more than before, numbered, and those that they have no more.

    Dimensions of other sources are compared by natural key: a fact keeps the version that it was loaded with.
    """
    fact, after = spec.fact, loads.then(load_id)
    edition = spec.dimension(spec.edition_dimension)
    labels = read_dimension(gold, edition, after).select(edition.surrogate_key, F.col(edition.natural_key).alias(spec.edition))
    own = labels.join(batches.corrected, spec.edition).select(edition.surrogate_key)
    before = read_facts(gold, fact, loads).join(own, edition.surrogate_key, "left_semi")
    events = batches.events.withColumns({new: F.col(old) for old, new in fact.measures.items() if new != old})
    now = conform(
        resolve_keys(events, lookups).withColumn(fact.surrogate_key, F.lit(0)), fact.schema
    ).drop(fact.surrogate_key)
    same = [name for name in fact.schema.names if name != fact.surrogate_key]
    carried = []
    for dim in spec.dimensions:
        if dim.source != "events":
            label = f"_key_of_{dim.table}"
            keys = read_dimension(gold, dim, after).select(dim.surrogate_key, F.col(dim.natural_key).alias(label))
            before, now = (rows.join(keys, dim.surrogate_key, "left") for rows in (before, now))
            same[same.index(dim.surrogate_key)] = label
            carried.append(dim.surrogate_key)
    added, keys = multiset_difference(before, now, fact.surrogate_key, same, carried)
    columns = [name for name in fact.schema.names if name != fact.surrogate_key]
    numbered = assign_keys(added.select(columns), fact.surrogate_key, columns, start, columns)
    return numbered, before.join(keys, fact.surrogate_key, "left_semi").select(fact.schema.names)


def _number_facts(
    spec: StarSpec, batches: Batches, lookups: Sequence[Lookup], start: int
) -> DataFrame:
    fact = spec.fact
    events = batches.events.withColumns(
        {new: F.col(old) for old, new in fact.measures.items() if new != old}
    )
    columns = [*(dim.surrogate_key for dim in spec.dimensions), *fact.measures.values()]
    if fact.order:
        return load_facts(
            events, lookups, fact.surrogate_key, columns, [_BATCH, *fact.order], start
        )
    content = F.xxhash64(*_used_columns(batches.events, spec))
    events = events.withColumn("_row", _row_hash(batches.events, spec, content))
    return fact_history(
        events, lookups, fact.surrogate_key, columns, F.col("_row"), _BATCH, start, batches.counts
    )


def _contents(found: DataFrame, spec: StarSpec, load_date) -> DataFrame:
    return found.select(F.col(spec.edition).alias("edition"), "row_count", "content", load_date.alias(_DATE))


def loaded_editions(gold: Gold, spec: StarSpec) -> DataFrame:
    """The editions in gold, with what was loaded of them, in however many loads."""
    dim = spec.dimension(spec.edition_dimension)
    labels = read_dimension(gold, dim).select(F.col(dim.natural_key).alias("edition"))
    sums = gold.read_all(_LOADED, _LOADED_SCHEMA).groupBy("edition").agg(
        F.sum("row_count").alias("loaded_rows"),
        F.sum("content").alias("loaded_content"),
        F.max(_DATE).alias("loaded_date"),
    )
    return labels.join(sums, "edition", "left").withColumnRenamed("edition", spec.edition)


def changed_editions(found: DataFrame, loaded: DataFrame, spec: StarSpec) -> DataFrame:
    """The loaded editions whose rows are others than those that were loaded."""
    same = F.col("row_count").eqNullSafe(F.col("loaded_rows")) & F.col("content").eqNullSafe(
        F.col("loaded_content")
    )
    return found.join(loaded, spec.edition).filter(~same)


def _refuse_changed(found: DataFrame, loaded: DataFrame, spec: StarSpec) -> None:
    changed = changed_editions(found, loaded, spec)
    seen = changed.agg(F.count(F.lit(1)).alias("n"), F.min(spec.edition).alias("label")).first()
    if seen["n"]:
        raise ChangedEditionError(
            f"{seen['n']} loaded editions have other rows now, the first is {seen['label']!r}: "
            "load them with corrections, add missing rows with load_batch, or rebuild"
        )


def _has_changes(gold: Gold, dim: DimensionSpec, regions: DataFrame) -> bool:
    """Whether a snapshot would add to a dimension, or change it."""
    existing = read_dimension(gold, dim)
    if dim.scd_type != 2:
        existing = existing.withColumn("is_current", F.lit(True))
    tracked = dim.tracked or [dim.natural_key]
    classes = classify_changes(existing, dimension_snapshots(regions, dim), dim.natural_key, tracked)
    wanted = ["new"] if dim.scd_type == 0 else ["new", "changed"]
    return not classes.filter(F.col("change").isin(wanted)).isEmpty()


def _load_regions(
    gold: Gold, spec: StarSpec, events: DataFrame, regions: DataFrame, day: date, source_name: str
) -> None:
    """Load the regions alone, if they differ from those in gold."""
    dims = [dim for dim in spec.dimensions if dim.source != "events"]
    marks = {_BATCH: F.lit(1), _DATE: F.lit(day)}
    dated = regions.withColumns(marks)
    if not any(_has_changes(gold, dim, dated) for dim in dims):
        return
    no_events = events.filter(F.lit(False)).withColumns(marks)
    no_contents = gold.spark.createDataFrame([], _LOADED_SCHEMA)
    rows = regions.count()
    steps = [("gold", source_name, dim.table, rows, "success") for dim in dims]
    load_star(
        gold,
        spec,
        Batches(no_events, day, {}, no_contents),
        regions,
        lambda: log_steps(gold.spark, gold.lineage_path(), steps),
    )


def load_batch(
    spark: SparkSession,
    events: DataFrame,
    regions: DataFrame,
    gold_path: str,
    load_date: date,
    spec: StarSpec = RESULTS_STAR,
    source_names: tuple[str, str] = ("events", "regions"),
    arrival: str | None = None,
) -> None:
    """Load silver events as one batch on top of the gold tables, whatever editions they hold.

    Both inputs are evaluated once and staged.
    """
    gold = Gold(spark, str(gold_path))
    with freed_after(spark, "batch"):
        events, regions = stage(events, "events"), stage(regions, "regions")
        batch = events.withColumns({_BATCH: F.lit(1), _DATE: F.lit(load_date)})
        sizes = {"events": events.count(), "regions": regions.count()}
        cells = stage(edition_cells(events, spec), "cells")
        counts = {(1, row[_CELL]): row["n"] for row in cells.groupBy(_CELL).agg(F.sum("row_count").alias("n")).collect()}
        contents = _contents(edition_contents(cells, spec), spec, F.lit(load_date))
        names = dict(zip(("events", "regions"), source_names))
        sources = [(dim.source, dim.table) for dim in spec.dimensions] + [("events", spec.fact.table)]
        steps = [("gold", names[kind], table, sizes[kind], "success") for kind, table in sources]
        load_star(
            gold,
            spec,
            Batches(batch, load_date, counts, contents, least=_least(cells.withColumn(_BATCH, F.lit(1)), spec)),
            regions,
            lambda: log_steps(spark, gold.lineage_path(), steps),
            arrival=arrival,
        )


def _log_editions(
    gold: Gold, spec: StarSpec, editions: DataFrame, region_rows: int, names: tuple[str, str]
) -> None:
    """One lineage row per edition and table, in load order; row counts are those of the input."""
    event_name = F.concat(F.lit(names[0] + "/"), spec.edition)
    tables = [(dim.table, dim.source) for dim in spec.dimensions] + [(spec.fact.table, "events")]
    steps = F.array(
        *(
            F.struct(
                F.lit(number).alias("step"),
                (event_name if source == "events" else F.lit(names[1])).alias("source"),
                F.lit(table).alias("target"),
                (F.col("row_count") if source == "events" else F.lit(region_rows)).alias("size"),
            )
            for number, (table, source) in enumerate(tables, start=1)
        )
    )
    last_id = max_key(read_lineage(gold.spark, gold.lineage_path()), "lineage_id")
    rows = editions.select(_BATCH, F.explode(steps).alias("_step")).select(
        (F.lit(last_id) + (F.col(_BATCH) - 1) * len(tables) + F.col("_step.step")).alias("lineage_id"),
        F.lit("gold").alias("layer"),
        "_step.source",
        "_step.target",
        F.col("_step.size").alias("row_count"),
        F.lit("success").alias("status"),
        F.lit(utc_now().isoformat(sep=" ")).cast("timestamp_ntz").alias("run_timestamp"),
    )
    append_rows(conform(rows, PIPELINE_LINEAGE).coalesce(1), gold.lineage_path())


def load_editions(
    spark: SparkSession,
    events: DataFrame,
    regions: DataFrame,
    gold_path: str,
    incremental: bool = False,
    spec: StarSpec = RESULTS_STAR,
    source_names: tuple[str, str] = ("events", "regions"),
    region_date: date | None = None,
    splice: bool = False,
    corrections: bool = False,
    cells: DataFrame | None = None,
) -> int:
    """Load every edition of the silver events in order and return how many were loaded.

    A full load rebuilds all tables. An incremental one adds the editions that are not loaded yet. It
    refuses, and loads nothing, if a loaded edition has other rows than those loaded, or if a new one
    comes before the newest loaded one (by number, then by label). With *splice* such late editions are
    loaded first, into the history that their keys have by then: versions, overwritten values and facts
    become those of a rebuild, with other surrogate keys. Type 0 rows stay as first loaded, and regions
    take no part. With *corrections* loaded editions that have other rows now are loaded anew, as late ones
    are: facts that an edition has no more are taken back, facts that it has more are added, alike ones
    stay, and versions and bindings become those of a rebuild. Versions that nothing backs any more stay
    with an empty interval, overwritten values of type 1 that only taken back rows had stay too, and
    editions that have no rows left stay as they were. Regions are merged by every
    increment: with new editions dated by the first of them, otherwise, if they differ, by
    *region_date*, which is the date of the newest loaded edition unless given. *cells* are the
    edition_cells() of the events, if a caller has them staged already.
    """
    events = require_columns(events, [spec.edition, spec.year])
    with freed_after(spark, "editions"):
        if cells is None:
            cells = stage(edition_cells(events, spec), "cells")
        return _load_editions(
            Gold(spark, str(gold_path)), events, regions, incremental, spec, source_names, region_date, splice, corrections,
            cells,
        )


def _load_editions(
    gold: Gold,
    events: DataFrame,
    regions: DataFrame,
    incremental: bool,
    spec: StarSpec,
    source_names: tuple[str, str],
    region_date: date | None,
    splice: bool,
    corrections: bool,
    cells: DataFrame,
) -> int:
    number = 0
    found = edition_contents(cells, spec)
    newest = None
    if incremental:
        loaded = loaded_editions(gold, spec)
        if corrections:
            number = _correct(gold, spec, events, cells, loaded, found, source_names)
        else:
            _refuse_changed(found, loaded, spec)
        place = F.struct(
            edition_order_key(F.col(spec.edition)).alias("order_key"), spec.edition, "loaded_date"
        )
        newest = loaded.agg(F.max(place)).first()[0]
        found = found.join(loaded, spec.edition, "left_anti")
    if newest is not None:
        label, key = F.col(spec.edition), edition_order_key(F.col(spec.edition))
        same = key == newest["order_key"]
        before = (key < newest["order_key"]) | (same & (label < newest[spec.edition]))
        late = found.filter(before)
        first = late.agg(F.min(label)).first()[0]
        if first is not None and not splice:
            raise LateEditionError(f"edition {first!r} comes before loaded edition {newest[spec.edition]!r}")
        if first is not None:
            number += _splice(gold, spec, events, cells, loaded, late, source_names)
            found = found.filter(~before)
    editions = _in_order(found, spec)
    listed = editions.collect()  # one row per edition
    if not listed:
        day = region_date or (newest and newest["loaded_date"])
        if day:
            _load_regions(gold, spec, events, regions, day, source_names[1])
        return number
    batches = _batches(events if newest is None else _of(events, listed, spec), cells, editions, listed, spec)
    load_star(
        gold,
        spec,
        batches,
        regions,
        lambda: _log_editions(gold, spec, editions, regions.count(), source_names),
        rebuild=not incremental,
    )
    return number + len(listed)


def _of(events: DataFrame, listed: Sequence[Row], spec: StarSpec) -> DataFrame:
    """The events of the listed editions. A constant filter lets files of other editions be skipped."""
    return events.filter(F.col(spec.edition).isin([row[spec.edition] for row in listed]))


def _least(cells: DataFrame, spec: StarSpec) -> DataFrame | None:
    """The least values in edition_cells() by edition and batch, if there are any; staged, so that they are broadcast."""
    if _LEAST not in cells.columns:
        return None
    return stage(cells.groupBy(spec.edition, _BATCH).agg(F.min(_LEAST).alias(_LEAST)), "least")


def _batches(
    events: DataFrame,
    cells: DataFrame,
    editions: DataFrame,
    listed: Sequence[Row],
    spec: StarSpec,
    places: DataFrame | None = None,
) -> Batches:
    own = cells.join(editions.select(spec.edition, _BATCH), spec.edition)
    counted = own.select(_BATCH, _CELL, "row_count")
    return Batches(
        events.join(editions.select(spec.edition, _BATCH, _DATE), spec.edition),
        min(listed, key=lambda row: row[_BATCH])[_DATE],
        {(row[_BATCH], row[_CELL]): row["row_count"] for row in counted.collect()},
        _contents(editions, spec, F.col(_DATE)),
        places,
        least=_least(own, spec),
    )


def _correct(
    gold: Gold,
    spec: StarSpec,
    events: DataFrame,
    cells: DataFrame,
    loaded: DataFrame,
    found: DataFrame,
    source_names: tuple[str, str],
) -> int:
    """Load the changed ones among the loaded editions anew; what was recorded of them is corrected by differences."""
    changed = stage(changed_editions(found, loaded, spec), "changed-editions")
    more = changed.select(
        F.col(spec.edition).alias("edition"),
        (F.col("row_count") - F.coalesce("loaded_rows", F.lit(0))).alias("row_count"),
        (F.col("content") - F.coalesce("loaded_content", F.lit(0))).cast("decimal(38,0)").alias("content"),
        load_date_of(F.col("_year")).alias(_DATE),
    )
    others = loaded.join(changed, spec.edition, "left_anti")
    return _splice(gold, spec, events, cells, others, changed.select(found.columns), source_names, more)


def _splice(
    gold: Gold,
    spec: StarSpec,
    events: DataFrame,
    cells: DataFrame,
    loaded: DataFrame,
    late: DataFrame,
    source_names: tuple[str, str],
    corrections: DataFrame | None = None,
) -> int:
    """Load the late editions among the loaded ones, without regions.

    With *corrections*, what to add to the recorded contents, they are loaded already and replace themselves.
    """
    date_of = load_date_of(F.col("_year"))
    known = loaded.select(spec.edition, F.col("loaded_date").alias(_DATE), F.lit(None).cast("long").alias("row_count"),
                          F.lit(None).cast("decimal(38,0)").alias("content"))
    dated = late.select(spec.edition, date_of.alias(_DATE), "row_count", F.col("content").cast("decimal(38,0)").alias("content"))
    placed = known.unionByName(dated).withColumn("order_key", edition_order_key(F.col(spec.edition)))
    placed = stage(assign_keys(placed, _BATCH, ["order_key", spec.edition]), "places")
    editions = placed.filter(F.col("row_count").isNotNull())
    listed = editions.collect()  # one row per edition
    if not listed:
        return 0
    places = placed.filter(F.col("row_count").isNull()).select(spec.edition, _BATCH, _DATE)
    batches = _batches(_of(events, listed, spec), cells, editions, listed, spec, places)
    if corrections is not None:
        batches = replace(batches, counts={}, contents=corrections, corrected=editions.select(spec.edition, _BATCH))
    stored = {dim.table: _as_source(read_dimension(gold, dim), dim) for dim in spec.dimensions if dim.source != "events"}
    regions = next(iter(stored.values()), events.limit(0))
    load_star(gold, spec, batches, regions, lambda: _log_editions(gold, spec, editions, 0, source_names))
    return len(listed)


def _as_source(rows: DataFrame, dim: DimensionSpec) -> DataFrame:
    """The stored current rows of a dimension in the form of its source, which change nothing when loaded."""
    rows = current(rows) if dim.scd_type == 2 else rows
    return rows.select(*(F.col(name).alias(source) for source, name in dim.columns.items()))


def run_pipeline(
    spark: SparkSession,
    data_dir: str,
    incremental: bool = False,
    fail_on_checks: bool = False,
    raw_schemas: Mapping[str, StructType] | None = None,
    multi_line: bool = True,
    region_date: date | None = None,
) -> Gold:
    """Raw CSV to bronze, silver and gold below *data_dir*, with checks and lineage.

    The raw inputs ``athlete_events.csv`` and ``noc_regions.csv`` are files or folders of files;
    *raw_schemas*, by name without suffix, save the pass that infers their types; without
    *multi_line* records, single files are split among tasks. See load_editions() for *region_date*.
    """
    data_dir = str(data_dir).rstrip("/")
    gold = Gold(spark, f"{data_dir}/gold")
    cleaning = {"athlete_events": EVENT_CLEANING, "noc_regions": REGION_CLEANING}
    rules = {"athlete_events": SILVER_EVENT_RULES, "noc_regions": SILVER_REGION_RULES}

    def to_silver(name: str) -> list[Step]:
        bronze, silver = f"{data_dir}/bronze/{name}", f"{data_dir}/silver/{name}"
        schema = (raw_schemas or {}).get(name)
        ingested = ingest_csv(spark, f"{data_dir}/raw/{name}.csv", bronze, schema, multi_line)
        cleaned = clean_to_silver(
            spark, bronze, silver, cleaning[name], f"silver.{name}", rules[name], fail_on_checks
        )
        return [
            ("bronze", f"raw/{name}.csv", f"bronze/{name}", ingested, "success"),
            ("silver", f"bronze/{name}", f"silver/{name}", cleaned, "success"),
        ]

    steps = [step for pair in _all_at_once(spark, to_silver, list(cleaning)) for step in pair]
    log_steps(spark, gold.lineage_path(), steps)

    tables = {name: spark.read.parquet(f"{data_dir}/silver/{name}") for name in cleaning}
    load_editions(
        spark,
        tables["athlete_events"],
        tables["noc_regions"],
        gold.path,
        incremental,
        RESULTS_STAR,
        ("silver/athlete_events", "silver/noc_regions"),
        region_date,
    )
    return gold
