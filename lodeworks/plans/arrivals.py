"""Increments from the files that have arrived since the last run.

A file stream with its checkpoint is the list of files seen: a run reads the new ones, and nothing of
what was loaded before. Files add rows, so an edition that is loaded already gets more of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodeworks.functions.columns import require_columns
from lodeworks.plans.specs import RESULTS_STAR, StarSpec
from lodeworks.plans.star import (
    changed_editions,
    edition_cells,
    edition_contents,
    load_batch,
    load_editions,
    loaded_editions,
)
from lodeworks.sources.gold import Gold
from lodeworks.sources.tables import freed_after, read_table, stage, staging_path


def load_arrivals(
    spark: SparkSession,
    events_path: str,
    schema: StructType,
    regions: DataFrame,
    gold_path: str,
    checkpoint: str,
    spec: StarSpec = RESULTS_STAR,
    source_names: tuple[str, str] = ("events", "regions"),
    splice: bool = False,
) -> int:
    """Load the silver events of all files that are new in *events_path*, and return their number of rows.

    New editions are loaded in order, late ones only with *splice* (see load_editions()). Rows of editions
    that are loaded already are added as one batch, dated by the newest loaded edition. If a run fails, its
    files are read again by the next one; what it has published by then is not loaded twice, and neither is
    an edition that arrives again unchanged.
    """
    gold = Gold(spark, str(gold_path))

    def load(batch: DataFrame, number: int) -> None:
        arrival = f"{checkpoint}#{number}"
        if gold.has_arrival(arrival):
            return
        with freed_after(spark, "arrivals"):
            # Read back by the caller's session: that of the stream plans without adaptive execution.
            path = staging_path(spark, "arrivals")
            batch.write.parquet(path)
            rows = require_columns(read_table(spark, schema, path), [spec.edition, spec.year])
            _load(gold, spec, rows, regions, source_names, splice, arrival)

    stream = spark.readStream.schema(schema).parquet(str(events_path))
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def _load(
    gold: Gold,
    spec: StarSpec,
    events: DataFrame,
    regions: DataFrame,
    source_names: tuple[str, str],
    splice: bool,
    arrival: str,
) -> None:
    spark, label = gold.spark, spec.edition
    cells = stage(edition_cells(events, spec), "cells")
    found = edition_contents(cells, spec)
    loaded = loaded_editions(gold, spec)
    known = stage(found.join(loaded.select(label), label).select(label), "known")
    more = stage(changed_editions(found, loaded, spec).select(label), "more")
    new = events.join(known, label, "left_anti")
    if not new.isEmpty():
        new_cells = cells.join(known, label, "left_anti")
        load_editions(spark, new, regions, gold.path, True, spec, source_names, splice=splice, cells=new_cells)
    late = events.join(more, label, "left_semi")
    if not late.isEmpty():
        day = loaded.agg(F.max("loaded_date")).first()[0]
        load_batch(spark, late, regions, gold.path, day, spec, source_names, arrival)
