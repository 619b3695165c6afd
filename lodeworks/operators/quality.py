"""Data-quality checks between layers.

A failed check of values gives a row count and the smallest value, at every size; unexpected_values() has them
all. All checks of a table are measured in one aggregation, or within the write of the table, plus one grouped
count per uniqueness check; only those counts reach the driver. A failed check is logged, and raised on request.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class QualityResult:
    check_name: str
    passed: bool
    details: str


class QualityError(Exception):
    """A data-quality check failed."""


@dataclass(frozen=True)
class NotEmpty:
    """The table has rows."""


@dataclass(frozen=True)
class NoNulls:
    """None of the columns holds a null (columns that do not exist are skipped)."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class Unique:
    """No two rows agree on all columns; nulls are equal."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class AcceptedValues:
    """The column holds only accepted values or null."""

    column: str
    accepted: tuple


Check = NotEmpty | NoNulls | Unique | AcceptedValues


def _is_missing(df: DataFrame, column: str) -> Column:
    missing = F.col(column).isNull()
    if dict(df.dtypes)[column] in ("double", "float"):
        missing = missing | F.isnan(column)
    return missing


def _is_unexpected(df: DataFrame, check: AcceptedValues) -> Column:
    accepted = [value for value in check.accepted if value is not None]
    return ~_is_missing(df, check.column) & ~F.col(check.column).isin(accepted)


def unexpected_values(df: DataFrame, check: AcceptedValues) -> DataFrame:
    """Every value outside the accepted set, with its row count."""
    return df.filter(_is_unexpected(df, check)).groupBy(check.column).count()


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> int:
    """Rows minus distinct keys. Counted per map task first, so a hot key stays small."""
    groups = df.groupBy(*columns).count()
    extra = F.coalesce(F.sum(F.col("count") - 1), F.lit(0))
    return groups.agg(extra.alias("extra")).first()["extra"]


def run_checks(
    df: DataFrame, table: str, checks: Iterable[Check], fail: bool = False
) -> list[QualityResult]:
    """Run the checks over *df* and log each result; with *fail*, raise when any check failed."""
    checks = list(checks)
    measures = _measures(df, checks)
    counted = {}
    if measures:
        exprs = [measure.alias(f"m{i}") for i, measure in enumerate(measures.values())]
        counted = dict(zip(measures, df.agg(*exprs).first()))
    return _judge(df, table, checks, counted, fail)


def write_checked(
    df: DataFrame,
    write: Callable[[DataFrame], DataFrame],
    table: str,
    checks: Iterable[Check],
    fail: bool = False,
) -> tuple[DataFrame, int, list[QualityResult]]:
    """Write *df*, run the checks and count the rows, all in one pass; only uniqueness is looked up behind it.

    *write* writes a frame and returns it as read back. Returns what was written, its number of rows and the
    results. With *fail*, an error is raised when any check failed, after the write.
    """
    checks = list(checks)
    measures = _measures(df, checks)
    observation = Observation()
    exprs = [measure.alias(f"m{i}") for i, measure in enumerate(measures.values())]
    written = write(df.observe(observation, F.count(F.lit(1)).alias("n_rows"), *exprs))
    found = observation.get
    counted = {name: found[f"m{i}"] for i, name in enumerate(measures)}
    return written, found["n_rows"], _judge(written, table, checks, counted, fail)


def _measures(df: DataFrame, checks: Sequence[Check]) -> dict[tuple, Column]:
    """The aggregates that the checks need, but for uniqueness."""
    measures = {}
    for number, check in enumerate(checks):
        if isinstance(check, NotEmpty):
            measures[number, None] = F.count(F.lit(1))
        elif isinstance(check, NoNulls):
            for column in check.columns:
                if column in df.columns:
                    measures[number, column] = F.count_if(_is_missing(df, column))
        elif isinstance(check, AcceptedValues):
            outside = _is_unexpected(df, check)
            measures[number, None] = F.count_if(outside)
            measures[number, "least"] = F.min(F.when(outside, F.col(check.column))).cast("string")
    return measures


def _judge(
    df: DataFrame, table: str, checks: Sequence[Check], counted: dict, fail: bool
) -> list[QualityResult]:
    results = []
    for number, check in enumerate(checks):
        if isinstance(check, NotEmpty):
            rows = counted[number, None]
            result = QualityResult(f"{table}:not_empty", rows > 0, f"{rows} rows")
        elif isinstance(check, NoNulls):
            nulls = {
                column: counted[number, column]
                for column in check.columns
                if counted.get((number, column), 0) > 0
            }
            details = f"values missing: {nulls}" if nulls else "every value present"
            result = QualityResult(f"{table}:no_nulls", not nulls, details)
        elif isinstance(check, Unique):
            extra = duplicate_count(df, check.columns)
            details = f"{extra} rows repeat the key {list(check.columns)}" if extra else "every key once"
            result = QualityResult(f"{table}:unique", extra == 0, details)
        else:
            rows, least = counted[number, None], counted[number, "least"]
            passed = rows == 0
            details = f"{rows} rows outside the set, the smallest value is {least}" if rows else "only accepted values"
            result = QualityResult(f"{table}:accepted_values({check.column})", passed, details)
        results.append(result)
    return report(results, fail)


def report(results: list[QualityResult], fail: bool = False) -> list[QualityResult]:
    """Log the results; with *fail*, raise when any of them failed."""
    for result in results:
        level = logging.INFO if result.passed else logging.WARNING
        outcome = "passed" if result.passed else "failed"
        logger.log(level, "check %s: [%s] %s", outcome, result.check_name, result.details)
    failed = [f"{result.check_name}: {result.details}" for result in results if not result.passed]
    if fail and failed:
        raise QualityError("; ".join(failed))
    return results


def check_not_empty(df: DataFrame, table: str) -> QualityResult:
    return run_checks(df, table, [NotEmpty()])[0]


def check_no_nulls(df: DataFrame, columns: Sequence[str], table: str) -> QualityResult:
    return run_checks(df, table, [NoNulls(tuple(columns))])[0]


def check_unique(df: DataFrame, columns: Sequence[str], table: str) -> QualityResult:
    return run_checks(df, table, [Unique(tuple(columns))])[0]


def check_accepted_values(
    df: DataFrame, column: str, accepted: Iterable, table: str
) -> QualityResult:
    return run_checks(df, table, [AcceptedValues(column, tuple(accepted))])[0]


def check_row_count_consistent(
    before: int, after: int, table: str, tolerance: float = 0.0
) -> QualityResult:
    """The share of rows lost is within the tolerance; gaining rows passes."""
    if before == 0:
        passed, details = True, "nothing to compare with"
    else:
        drop = 1.0 - after / before
        passed, details = drop <= tolerance, f"before={before}, after={after}, drop={drop:.2%}"
    result = QualityResult(f"{table}:row_count_consistent", passed, details)
    return report([result])[0]


def results_frame(spark: SparkSession, results: Sequence[QualityResult]) -> DataFrame:
    """Check results as rows."""
    rows = [(result.check_name, result.passed, result.details) for result in results]
    return spark.createDataFrame(rows, "check_name string, passed boolean, details string")


class ConstraintError(Exception):
    """Rows violate a declared NOT NULL or PRIMARY KEY constraint."""


def enforce_constraints(
    df: DataFrame, table: str, not_null: Sequence[str] = (), primary_key: Sequence[str] = ()
) -> DataFrame:
    """Raise when a constraint is violated; otherwise return *df*."""
    checks: list[Check] = [NoNulls(tuple(not_null))] if not_null else []
    if primary_key:
        checks.append(Unique(tuple(primary_key)))
    try:
        run_checks(df, table, checks, fail=True)
    except QualityError as error:
        raise ConstraintError(str(error)) from error
    return df
