"""Editions that arrive late, or changed: spliced into the history of the keys they hold.

A version tells what a key was, not in which editions it appeared. The facts tell that: each one
points to the version that was current in its edition. So the snapshots of a key can be had again
from its versions and facts, and only the keys that the late editions hold need it. Their chains
are folded anew over old and late snapshots; versions keep their surrogate key where their start is
still one, rows that did not change are not written, and facts that now belong to another version
are written once more, to be merged at read.

An edition that comes with other rows than were loaded is spliced in as if it were late: its facts no
longer count for the history of their keys, which also takes part where the edition holds it no more.
Facts that it lacks now are written once more as taken back, and readers leave them out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from lodeworks.operators.keys import assign_keys, max_key
from lodeworks.operators.scd import scd1_changes, scd2_versions
from lodeworks.plans.specs import DimensionSpec, FactSpec
from lodeworks.sources.gold import Gold, Loads, Merged
from lodeworks.sources.tables import stage

_BATCH = "edition_seq"
_DATE = "load_date"
TAKEN_BACK = "taken_back"


@dataclass(frozen=True)
class Spliced:
    """What a late edition makes of a dimension: rows to write, (key, batch) bindings, and facts to rebind.

    *rebound* has, per edition and surrogate key, the surrogate key that its facts now have.
    """

    changed: DataFrame
    bindings: DataFrame | None = None
    rebound: DataFrame | None = None


def rebound_table(fact: FactSpec) -> Merged:
    """Where facts are kept that were written again, with other dimension keys or as taken back."""
    schema = StructType([*fact.schema, StructField(TAKEN_BACK, BooleanType())])
    return Merged(f"{fact.table}_rebound", schema, fact.surrogate_key, fact.partition_by)


def read_facts(gold: Gold, fact: FactSpec, loads: Loads | None = None) -> DataFrame:
    """The facts of all loads, each as it was written last, without those taken back."""
    loads = gold.loads() if loads is None else loads
    facts = gold.read_all(fact.table, fact.schema, loads)
    if not loads.rebound:
        return facts
    again = gold.read_merged(rebound_table(fact), Loads(loads.last, (), loads.rebound))
    kept = facts.join(again.select(fact.surrogate_key), fact.surrogate_key, "left_anti")
    valid = again.filter(~F.coalesce(TAKEN_BACK, F.lit(False)))
    return kept.select(fact.schema.names).unionByName(valid.select(fact.schema.names))


def _differing(rows: DataFrame, before: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """The rows that *before* does not have in this form."""
    was = before.select(key, F.struct(*names).alias("_was"))
    joined = rows.select(*names).join(was, key, "left")
    return joined.filter(~F.struct(*names).eqNullSafe(F.col("_was"))).select(*names)


def splice_versions(
    snapshots: DataFrame,
    dim: DimensionSpec,
    existing: DataFrame,
    facts: DataFrame,
    editions: DataFrame,
    changed_editions: DataFrame | None = None,
) -> Spliced:
    """A type 2 dimension with late snapshots (key, tracked columns, edition_seq, load_date).

    *facts* have the surrogate key of each fact and of its edition, *editions* place and date of the loaded ones by
    their surrogate key ``edition_sk``. Tracked columns that riding ones go with start with a version.

    *changed_editions* are places of loaded editions that the snapshots replace; *editions* lacks them. Versions
    that nothing backs any more are closed with an empty interval.
    """
    nk, sk, names = dim.natural_key, dim.surrogate_key, dim.schema.names
    snapshots = stage(snapshots, f"{dim.table}-late")
    touched = snapshots.select(nk)
    if changed_editions is not None:
        replaced = stage(facts.join(changed_editions, "edition_sk").select(sk, _BATCH).distinct(), f"{dim.table}-replaced")
        touched = touched.union(existing.join(replaced, sk, "left_semi").select(nk))
    chains = stage(existing.join(touched.distinct(), nk, "left_semi"), f"{dim.table}-chains")
    bound = facts.join(chains.select(sk, nk), sk).distinct().join(editions, "edition_sk")
    bound = stage(bound, f"{dim.table}-bound")
    old = bound.drop(nk).join(chains.drop("valid_from", "valid_to", "is_current"), sk).select(snapshots.columns)
    folded = scd2_versions(
        old.unionByName(snapshots), nk, dim.tracked, sk, last_key=0, load_date=_DATE, batch=_BATCH
    )
    versions = stage(folded.changed.withColumnRenamed(sk, "_fresh"), f"{dim.table}-folded")
    bindings = stage(folded.bindings.withColumnRenamed(sk, "_fresh"), f"{dim.table}-folds")

    # The start of an old version lies in one new version, which takes its key.
    held = bound.select(nk, sk, _BATCH)
    if changed_editions is not None:
        # Where a changed edition still holds a key, its old version is one to go on with.
        held = held.union(replaced.join(chains.select(sk, nk), sk).select(nk, sk, _BATCH))
        held = held.join(bindings, [nk, _BATCH], "left_semi")
    starts = held.groupBy(nk, sk).agg(F.min(_BATCH).alias(_BATCH))
    taken = bindings.join(starts, [nk, _BATCH]).groupBy("_fresh").agg(F.min_by(sk, _BATCH).alias(sk))
    new = versions.select("_fresh").join(taken, "_fresh", "left_anti")
    numbered = assign_keys(new, sk, ["_fresh"], max_key(existing, sk)).select("_fresh", sk)
    keys = stage(taken.unionByName(numbered), f"{dim.table}-keys")

    changed = _differing(versions.join(keys, "_fresh"), chains, sk, names)
    if changed_editions is not None:
        unbacked = chains.filter("is_current OR valid_to > valid_from").join(keys, sk, "left_anti")
        closed = unbacked.withColumns({"valid_to": F.col("valid_from"), "is_current": F.lit(False)})
        changed = changed.unionByName(closed.select(names))
    bindings = bindings.join(keys, "_fresh").drop("_fresh")
    again = bound.select(nk, _BATCH, "edition_sk", F.col(sk).alias("_old")).join(bindings, [nk, _BATCH])
    rebound = again.filter(F.col("_old") != F.col(sk)).select("edition_sk", "_old", F.col(sk).alias("_new"))
    return Spliced(changed, bindings, stage(rebound, f"{dim.table}-rebound"))


def splice_overwrites(
    snapshots: DataFrame, dim: DimensionSpec, existing: DataFrame, facts: DataFrame, editions: DataFrame
) -> Spliced:
    """A type 1 dimension with late snapshots: they overwrite only what no later edition has overwritten."""
    nk, sk, names = dim.natural_key, dim.surrogate_key, dim.schema.names
    snapshots = stage(snapshots.drop(_DATE), f"{dim.table}-late")
    known = stage(existing.join(snapshots.select(nk).distinct(), nk, "left_semi"), f"{dim.table}-known")
    places = editions.select("edition_sk", _BATCH)
    seen = facts.join(known.select(sk), sk, "left_semi").distinct().join(places, "edition_sk")
    seen = seen.groupBy(sk).agg(F.min(_BATCH).alias("_first"), F.max(_BATCH).alias("_last"))
    placed = known.join(seen, sk)
    # The stored row stands for the first edition, whose other columns it keeps, and for the last one.
    both = F.array_distinct(F.array("_first", "_last"))
    old = placed.withColumn(_BATCH, F.explode(both)).select(snapshots.columns)
    _, folded = scd1_changes(old.unionByName(snapshots), nk, dim.tracked)
    keyed = stage(folded.join(known.select(nk, sk), nk, "left"), f"{dim.table}-folded")
    new = assign_keys(keyed.filter(F.col(sk).isNull()).drop(sk), sk, [nk], max_key(existing, sk))
    return Spliced(_differing(keyed.filter(F.col(sk).isNotNull()).unionByName(new), known, sk, names))


def rebind(facts: DataFrame, fact: FactSpec, edition_key: str, rebound: dict[str, DataFrame]) -> DataFrame:
    """The facts whose key in a dimension (by its surrogate key column) is another one now."""
    columns = {}
    # With one dimension only those facts take part in the join.
    how = "inner" if len(rebound) == 1 else "left"
    for sk, moved in rebound.items():
        new = f"_new_{sk}"
        renamed = moved.select(F.col("edition_sk").alias(edition_key), F.col("_old").alias(sk), F.col("_new").alias(new))
        facts = facts.join(renamed, [edition_key, sk], how)
        columns[sk] = new
    touched = facts.filter(F.coalesce(*columns.values()).isNotNull())
    moved = touched.withColumns({sk: F.coalesce(new, sk) for sk, new in columns.items()})
    return moved.select(fact.schema.names)
