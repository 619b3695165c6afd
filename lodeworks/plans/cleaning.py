"""Bronze to silver: declarative cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lodeworks.functions.columns import (
    cast_columns,
    null_sentinels,
    rename_columns,
    trim_columns,
)
from lodeworks.operators.dedupe import dedupe_rows, keep_first
from lodeworks.operators.quality import (
    AcceptedValues,
    Check,
    NoNulls,
    NotEmpty,
    Unique,
    write_checked,
)
from lodeworks.sources.tables import write_table


@dataclass(frozen=True)
class CleaningSpec:
    """Steps in the order they apply; *unique_by* keeps one row per key instead of distinct rows."""

    renames: Mapping[str, str] = field(default_factory=dict)
    casts: Mapping[str, str] = field(default_factory=dict)
    trims: tuple[str, ...] = ()
    sentinels: Mapping[str, str] = field(default_factory=dict)
    unique_by: tuple[str, ...] = ()


# Column names, types and markers of the raw event and region files.
EVENT_CLEANING = CleaningSpec(
    renames={
        "ID": "athlete_id",
        "Name": "name",
        "Sex": "sex",
        "Age": "age",
        "Height": "height",
        "Weight": "weight",
        "Team": "team",
        "NOC": "noc",
        "Games": "games",
        "Year": "year",
        "Season": "season",
        "City": "city",
        "Sport": "sport",
        "Event": "event",
        "Medal": "medal",
    },
    casts={
        "athlete_id": "bigint",
        "year": "bigint",
        "age": "double",
        "height": "double",
        "weight": "double",
    },
    trims=("name", "sex", "team", "noc", "games", "season", "city", "sport", "event"),
    sentinels={"medal": "NA"},
)
REGION_CLEANING = CleaningSpec(renames={"NOC": "noc"}, trims=("noc",), unique_by=("noc",))

# What the silver tables must satisfy.
SILVER_EVENT_RULES = (
    NotEmpty(),
    NoNulls(("athlete_id", "noc", "games", "sport", "event")),
    AcceptedValues("season", ("Summer", "Winter")),
    AcceptedValues("sex", ("M", "F")),
    AcceptedValues("medal", ("Gold", "Silver", "Bronze", None)),
)
SILVER_REGION_RULES = (NotEmpty(), Unique(("noc",)))


def clean_table(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Rename, cast, trim, null the sentinels, and remove duplicates (which need the trim first)."""
    df = rename_columns(df, spec.renames)
    df = cast_columns(df, spec.casts) if spec.casts else df
    df = trim_columns(df, spec.trims) if spec.trims else df
    df = null_sentinels(df, spec.sentinels) if spec.sentinels else df
    if not spec.unique_by:
        return dedupe_rows(df)
    others = [name for name in df.columns if name not in spec.unique_by]
    return keep_first(df, spec.unique_by, others or spec.unique_by)


def clean_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    spec: CleaningSpec,
    table: str = "silver",
    rules: Sequence[Check] = (),
    fail: bool = False,
) -> int:
    """Clean a bronze table into a silver table and return the number of rows written.

    The rows are counted, and the rules of the *table* checked, while they are written.
    """
    cleaned = clean_table(spark.read.parquet(str(bronze_path)), spec)
    return write_checked(cleaned, lambda df: write_table(df, silver_path), table, rules, fail)[1]


def clean_athlete_events(spark: SparkSession, bronze_path: str, silver_path: str) -> int:
    return clean_to_silver(spark, bronze_path, silver_path, EVENT_CLEANING)


def clean_noc_regions(spark: SparkSession, bronze_path: str, silver_path: str) -> int:
    return clean_to_silver(spark, bronze_path, silver_path, REGION_CLEANING)
