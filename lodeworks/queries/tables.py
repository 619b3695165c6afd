"""The supplied tables, in the shapes the queries need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators.dedupe import keep_first

SPLIT_YEAR = 1998  # orders before this year form the first of two batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_snapshots(spark: SparkSession, sf_dir: str, batch) -> DataFrame:
    """Per customer and batch, priority and status of the first order; *batch* numbers the orders."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_nk"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        "o_orderdate",
        "o_orderkey",
        batch.alias("edition_seq"),
    )
    first = keep_first(orders, ["customer_nk", "edition_seq"], ["o_orderdate", "o_orderkey"])
    return first.drop("o_orderdate", "o_orderkey")


def by_year():
    """Every order year is a batch."""
    return F.year("o_orderdate").cast("bigint")


def by_half():
    """Two batches: orders before the split year, and the rest."""
    return F.when(F.year("o_orderdate") < SPLIT_YEAR, 1).otherwise(2)


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates in ISO form, which every client shows alike."""
    return df.withColumns(
        {name: F.col(name).cast("string") for name, kind in df.dtypes if kind == "date"}
    )


# SQL building blocks.


def customer_snapshots_sql(batch: str) -> str:
    """The rows of :func:`customer_snapshots`; *batch* is an SQL expression over orders."""
    return f"""
        SELECT o_custkey AS customer_nk, o_orderpriority AS priority, o_orderstatus AS status,
               edition_seq
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, edition_seq
                                           ORDER BY o_orderdate, o_orderkey) AS rn
              FROM (SELECT *, {batch} AS edition_seq FROM orders))
        WHERE rn = 1"""


BY_YEAR_SQL = "CAST(year(o_orderdate) AS BIGINT)"
BY_HALF_SQL = f"CASE WHEN year(o_orderdate) < {SPLIT_YEAR} THEN 1 ELSE 2 END"


def versions_sql(
    snapshots: str, key: str, tracked: list[str], surrogate_key: str, load_date: str
) -> str:
    """CTEs ending in ``versions``: all SCD2 versions of the snapshots, with the batch they start in."""
    differs = " OR ".join(
        f"coalesce(CAST(lag({name}) OVER w AS VARCHAR), '') <> coalesce(CAST({name} AS VARCHAR), '')"
        for name in tracked
    )
    return f"""
        snapshots AS ({snapshots}),
        flagged AS (
            SELECT *, row_number() OVER w = 1 AS is_new, row_number() OVER w = 1 OR {differs} AS starts
            FROM snapshots WINDOW w AS (PARTITION BY {key} ORDER BY edition_seq)),
        kept AS (
            SELECT *, lead(edition_seq) OVER (PARTITION BY {key} ORDER BY edition_seq) AS next_seq
            FROM flagged WHERE starts),
        dated AS (
            SELECT *, {load_date.format(seq="edition_seq")} AS valid_from,
                   CASE WHEN next_seq IS NULL THEN DATE '9999-12-31'
                        ELSE {load_date.format(seq="next_seq")} END AS valid_to
            FROM kept),
        versions AS (
            SELECT CAST(row_number() OVER (ORDER BY edition_seq, is_new, {key}) AS BIGINT)
                       AS {surrogate_key},
                   {key}, {", ".join(tracked)}, valid_from, valid_to, next_seq IS NULL AS is_current,
                   edition_seq, next_seq
            FROM dated)"""


def versions_columns_sql(key: str, tracked: list[str], surrogate_key: str) -> str:
    return f"""{surrogate_key}, {key}, {", ".join(tracked)}, CAST(valid_from AS VARCHAR) AS valid_from,
               CAST(valid_to AS VARCHAR) AS valid_to, is_current"""


JAN_FIRST_SQL = "make_date(CAST({seq} AS INTEGER), 1, 1)"
