"""Column-level building blocks. Everything here is a narrow, codegen-friendly projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns (case-insensitively); names that are not present are ignored."""
    return df.withColumnsRenamed(dict(names))


def _lenient(df: DataFrame, name: str, target: str) -> Column:
    col = F.col(name)
    if target in _INTEGRAL and dict(df.dtypes).get(name) == "string":
        # "22.0" counts as 22 in a lenient cast, while try_cast alone would reject it.
        col = F.regexp_replace(col, r"^(\s*[+-]?\d+)\.\d*\s*$", "$1")
    return col.try_cast(target)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to the given types; text that does not parse becomes null."""
    return df.withColumns({name: _lenient(df, name, target) for name, target in types.items()})


def trim_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip leading and trailing spaces (only spaces: tabs and newlines stay)."""
    return df.withColumns({name: F.trim(F.col(name)) for name in columns})


def null_sentinels(df: DataFrame, sentinels: Mapping[str, str]) -> DataFrame:
    """Replace a marker text such as ``"NA"`` by null."""
    return df.withColumns(
        {name: F.nullif(F.col(name), F.lit(marker)) for name, marker in sentinels.items()}
    )


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is null."""
    return df.na.drop(subset=list(columns))


def current(df: DataFrame) -> DataFrame:
    """The open versions of an SCD2 table."""
    return df.filter(F.col("is_current"))


def edition_order_key(label: Column) -> Column:
    """The leading integer of an edition label (``"1996 Summer"`` gives 1996), or 0 without one."""
    token = F.split(label, " ")[0]
    number = F.when(token.rlike("^[0-9]+$"), token.try_cast("bigint"))
    return F.coalesce(number, F.lit(0).cast("bigint"))


def load_date_of(year: Column) -> Column:
    """January 1 of a year."""
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1))


def changed_expr(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True when any (old, new) pair differs as text. Null and the empty text count as equal."""
    changed = F.lit(False)
    for old, new in pairs:
        blank = F.lit("")
        changed = changed | (
            F.coalesce(old.cast("string"), blank) != F.coalesce(new.cast("string"), blank)
        )
    return changed


def percent_text(ratio: Column) -> Column:
    """A ratio as a percentage with two decimals, such as ``12.50%``."""
    return F.format_string("%.2f%%", ratio * F.lit(100.0))
