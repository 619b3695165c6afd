"""Star schemas as data: which columns feed which table, and how each dimension changes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql.types import StructType

from lodeworks.schemas import DIM_ATHLETE, DIM_EVENT, DIM_GAME, DIM_NOC, FACT_RESULTS


@dataclass(frozen=True)
class DimensionSpec:
    """A dimension fed from the events or the regions.

    *columns* maps source columns to gold columns; the first is the natural key. *order* gives the
    source columns that decide which row of a batch is kept per key; by default the dimension's own
    columns, so that the result does not depend on the order of the rows.
    """

    table: str
    schema: StructType
    scd_type: int
    surrogate_key: str
    columns: Mapping[str, str]
    tracked: tuple[str, ...] = ()
    source: str = "events"
    order: tuple[str, ...] = ()

    @property
    def source_key(self) -> str:
        return next(iter(self.columns))

    @property
    def natural_key(self) -> str:
        return self.columns[self.source_key]


@dataclass(frozen=True)
class FactSpec:
    """One fact per event. *measures* maps source to gold columns.

    Facts are numbered batch by batch; within a batch by content, or by *order* if it is given.
    """

    table: str
    schema: StructType
    surrogate_key: str
    measures: Mapping[str, str]
    partition_by: tuple[str, ...] = ()
    order: tuple[str, ...] = ()


@dataclass(frozen=True)
class StarSpec:
    """*edition* and *year* name the event columns that split events into batches and date them."""

    edition: str
    year: str
    edition_dimension: str
    dimensions: tuple[DimensionSpec, ...]
    fact: FactSpec

    def dimension(self, table: str) -> DimensionSpec:
        return next(dim for dim in self.dimensions if dim.table == table)


# The tables, columns, change types and tracked columns of the results star.
RESULTS_STAR = StarSpec(
    edition="games",
    year="year",
    edition_dimension="dim_game",
    dimensions=(
        DimensionSpec(
            table="dim_game",
            schema=DIM_GAME,
            scd_type=0,
            surrogate_key="game_sk",
            columns={"games": "games", "year": "year", "season": "season", "city": "city"},
        ),
        DimensionSpec(
            table="dim_event",
            schema=DIM_EVENT,
            scd_type=1,
            surrogate_key="event_sk",
            columns={"event": "event_name", "sport": "sport", "season": "season"},
            tracked=("sport", "season"),
        ),
        DimensionSpec(
            table="dim_athlete",
            schema=DIM_ATHLETE,
            scd_type=2,
            surrogate_key="athlete_sk",
            columns={"athlete_id": "athlete_nk", "name": "name", "sex": "sex", "team": "team"},
            tracked=("name", "sex", "team"),
        ),
        DimensionSpec(
            table="dim_noc",
            schema=DIM_NOC,
            scd_type=2,
            surrogate_key="noc_sk",
            columns={"noc": "noc_code", "region": "region", "notes": "notes"},
            tracked=("region", "notes"),
            source="regions",
        ),
    ),
    fact=FactSpec(
        table="fact_results",
        schema=FACT_RESULTS,
        surrogate_key="result_sk",
        measures={"medal": "medal", "age": "age", "height": "height", "weight": "weight"},
        partition_by=("game_sk",),
    ),
)
