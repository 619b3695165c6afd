"""Declared table schemas, and conforming data to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType



def table_schema(columns: Mapping[str, str], not_null: Sequence[str]) -> StructType:
    """A schema from column names and type names (such as ``long``), in order."""
    schema = StructType()
    for name, type_name in columns.items():
        schema.add(name, type_name, nullable=name not in not_null)
    return schema


# The gold tables that queries run against.
DIM_GAME = table_schema(
    {"game_sk": "long", "games": "string", "year": "integer", "season": "string", "city": "string"},
    not_null=("game_sk", "games", "year", "season", "city"),
)
DIM_EVENT = table_schema(
    {"event_sk": "long", "event_name": "string", "sport": "string", "season": "string"},
    not_null=("event_sk", "event_name", "sport", "season"),
)
DIM_ATHLETE = table_schema(
    {
        "athlete_sk": "long",
        "athlete_nk": "long",
        "name": "string",
        "sex": "string",
        "team": "string",
        "valid_from": "date",
        "valid_to": "date",
        "is_current": "boolean",
    },
    not_null=("athlete_sk", "athlete_nk", "valid_from", "valid_to", "is_current"),
)
DIM_NOC = table_schema(
    {
        "noc_sk": "long",
        "noc_code": "string",
        "region": "string",
        "notes": "string",
        "valid_from": "date",
        "valid_to": "date",
        "is_current": "boolean",
    },
    not_null=("noc_sk", "noc_code", "valid_from", "valid_to", "is_current"),
)
FACT_RESULTS = table_schema(
    {
        "result_sk": "long",
        "athlete_sk": "long",
        "event_sk": "long",
        "noc_sk": "long",
        "game_sk": "long",
        "medal": "string",
        "age": "double",
        "height": "double",
        "weight": "double",
    },
    not_null=("result_sk",),
)
PIPELINE_LINEAGE = table_schema(
    {
        "lineage_id": "long",
        "layer": "string",
        "source": "string",
        "target": "string",
        "row_count": "long",
        "status": "string",
        "run_timestamp": "timestamp_ntz",
    },
    not_null=(
        "lineage_id", "layer", "source", "target", "row_count", "status", "run_timestamp",
    ),
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in the declared order and cast them to the declared types.

    A null in a column declared NOT NULL fails the job that writes or reads the result.
    """
    return df.select(*(_conformed(field).alias(field.name) for field in schema))


def _conformed(field: StructField) -> Column:
    value = F.col(field.name).cast(field.dataType)
    if field.nullable:
        return value
    failure = F.raise_error(F.lit(f"null in NOT NULL column {field.name}"))
    return F.coalesce(value, failure.cast(field.dataType))
