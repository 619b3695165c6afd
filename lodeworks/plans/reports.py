"""Queries over a loaded star."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.functions.columns import current
from lodeworks.operators.lineage import read_lineage
from lodeworks.plans.specs import RESULTS_STAR, StarSpec
from lodeworks.plans.splice import read_facts
from lodeworks.plans.star import read_dimension
from lodeworks.sources.gold import Gold


def count_by_entity(
    facts: DataFrame,
    dimension: DataFrame,
    surrogate_key: str,
    counted: str,
    by: Sequence[str],
    name: str,
) -> DataFrame:
    """Count the facts with a non-null *counted* column per value of the dimension columns *by*.

    Facts are counted per surrogate key first, so the join and the second aggregation see one row
    per key however many facts a key has.
    """
    per_key = facts.filter(F.col(counted).isNotNull()).groupBy(surrogate_key).agg(
        F.count(F.lit(1)).alias("_n")
    )
    joined = per_key.join(dimension.select(surrogate_key, *by), surrogate_key)
    return joined.groupBy(*by).agg(F.sum("_n").alias(name))


def top_entities(
    facts: DataFrame,
    dimension: DataFrame,
    surrogate_key: str,
    counted: str,
    by: Sequence[str],
    name: str = "medals",
    n: int = 10,
    only_current: bool = True,
) -> DataFrame:
    """The *n* entities with the most counted facts; ties are broken by the entity columns.

    With *only_current*, facts that belong to an expired version are left out.
    """
    rows = current(dimension) if only_current else dimension
    totals = count_by_entity(facts, rows, surrogate_key, counted, by, name)
    return totals.orderBy(F.desc(name), *by).limit(n)


def register_star(spark: SparkSession, gold_path: str, spec: StarSpec = RESULTS_STAR) -> None:
    """Make the published gold tables available to ``spark.sql`` under their names."""
    gold = Gold(spark, str(gold_path))
    for dim in spec.dimensions:
        read_dimension(gold, dim).createOrReplaceTempView(dim.table)
    read_facts(gold, spec.fact).createOrReplaceTempView(spec.fact.table)
    read_lineage(spark, gold.lineage_path()).createOrReplaceTempView("pipeline_lineage")
