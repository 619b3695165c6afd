"""The lineage table: what was processed, from where to where, how many rows, when."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from lodeworks.operators.keys import max_key
from lodeworks.schemas import PIPELINE_LINEAGE
from lodeworks.sources.tables import append_rows, read_table_or_empty

# layer, source, target, row_count, status
Step = tuple[str, str, str, int, str]


def utc_now() -> datetime:
    """The current time in UTC, without a zone."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    return read_table_or_empty(spark, path, PIPELINE_LINEAGE)


def lineage_rows(spark: SparkSession, steps: Sequence[Step], last_id: int = 0) -> DataFrame:
    """Lineage records for steps in the order they ran, stamped with the current UTC time."""
    now = utc_now()
    rows = [(last_id + number, *step, now) for number, step in enumerate(steps, start=1)]
    return spark.createDataFrame(rows, PIPELINE_LINEAGE)


def log_steps(spark: SparkSession, path: str, steps: Sequence[Step]) -> None:
    """Append records for several steps in one write; ids continue from the largest in use."""
    last_id = max_key(read_lineage(spark, path), "lineage_id")
    append_rows(lineage_rows(spark, steps, last_id).coalesce(1), path)


def log_lineage(
    spark: SparkSession,
    path: str,
    layer: str,
    source: str,
    target: str,
    row_count: int,
    status: str = "success",
) -> None:
    """Append one record."""
    log_steps(spark, path, [(layer, source, target, row_count, status)])
