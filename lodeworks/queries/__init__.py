"""Registered queries: each operator over the supplied tables, with the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lodeworks.queries import cleaning, dimensions, quality, star

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str


def registry() -> dict[str, Registered]:
    found = {}
    for module in (cleaning, dimensions, quality, star):
        for name, (run, sql) in module.QUERIES.items():
            found[name] = Registered(run, sql)
    return found
