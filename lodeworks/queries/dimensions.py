"""Slowly changing dimensions over the supplied tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.functions.columns import load_date_of
from lodeworks.operators.dedupe import keep_first
from lodeworks.operators.scd import (
    as_of,
    as_of_sliced,
    classify_changes,
    scd0_history,
    scd0_merge,
    scd1_history,
    scd1_merge,
    scd2_history,
    scd2_merge,
    scd2_versions,
)
from lodeworks.queries.tables import (
    BY_HALF_SQL,
    BY_YEAR_SQL,
    JAN_FIRST_SQL,
    SPLIT_YEAR,
    by_half,
    by_year,
    customer_snapshots,
    customer_snapshots_sql,
    dates_as_text,
    table,
    versions_columns_sql,
    versions_sql,
)

_TRACKED = ["priority", "status"]
_HALF_DATES = {1: date(1995, 1, 1), 2: date(SPLIT_YEAR, 1, 1)}
_HALF_DATE_SQL = f"CASE WHEN {{seq}} = 1 THEN DATE '1995-01-01' ELSE DATE '{SPLIT_YEAR}-01-01' END"


def _yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = customer_snapshots(spark, sf_dir, by_year())
    return snapshots.withColumn("load_date", load_date_of(F.col("edition_seq")))


def _halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    snapshots = customer_snapshots(spark, sf_dir, by_half())
    return [
        snapshots.filter(F.col("edition_seq") == half).drop("edition_seq") for half in (1, 2)
    ]


def _versions(df: DataFrame) -> DataFrame:
    return dates_as_text(
        df.select("customer_sk", "customer_nk", *_TRACKED, "valid_from", "valid_to", "is_current")
    )


def scd0_history_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd0_history(customer_snapshots(spark, sf_dir, by_year()), "customer_nk", "customer_sk")


def scd0_merge_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _halves(spark, sf_dir)
    existing = scd0_merge(None, first, "customer_nk", "customer_sk")
    return scd0_merge(existing, second, "customer_nk", "customer_sk")


def _part_snapshots(spark: SparkSession, sf_dir: str, batch) -> DataFrame:
    """Per part and batch, status and return flag (null for N) of the first line."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part_nk"),
        F.col("l_linestatus").alias("line_status"),
        F.nullif("l_returnflag", F.lit("N")).alias("return_flag"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.year("l_shipdate").cast("bigint").alias("ship_year"),
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_suppkey",
    ).withColumn("edition_seq", batch)
    order = ["ship_date", "l_orderkey", "l_linenumber", "l_extendedprice", "l_suppkey",
             "line_status", "return_flag"]
    first = keep_first(lines, ["part_nk", "edition_seq"], order)
    return first.select("part_nk", "line_status", "return_flag", "ship_year", "edition_seq")


def scd1_history_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = _part_snapshots(spark, sf_dir, F.col("ship_year"))
    return scd1_history(snapshots, "part_nk", ["line_status", "return_flag"], "part_sk")


def scd1_merge_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.when(F.col("ship_year") < SPLIT_YEAR, 1).otherwise(2)
    snapshots = _part_snapshots(spark, sf_dir, half)
    existing = None
    for number in (1, 2):
        batch = snapshots.filter(F.col("edition_seq") == number).drop("edition_seq")
        existing = scd1_merge(existing, batch, "part_nk", ["line_status", "return_flag"], "part_sk")
    return existing


def scd1_without_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _halves(spark, sf_dir)
    existing = scd1_merge(None, first, "customer_nk", _TRACKED)
    # The second batch lacks a tracked column: it is left alone.
    return scd1_merge(existing, second.drop("status"), "customer_nk", _TRACKED)


def scd2_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = customer_snapshots(spark, sf_dir, F.lit(1)).drop("edition_seq")
    loaded = scd2_merge(None, snapshots, "customer_nk", _TRACKED, "customer_sk", date(1995, 1, 1))
    return _versions(loaded)


def scd2_merge_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing = None
    for number, batch in enumerate(_halves(spark, sf_dir), start=1):
        existing = scd2_merge(
            existing, batch, "customer_nk", _TRACKED, "customer_sk", _HALF_DATES[number]
        )
    return _versions(existing)


def scd2_history_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(
        scd2_history(_yearly(spark, sf_dir), "customer_nk", _TRACKED, "customer_sk")
    )


def scd2_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_versions(_yearly(spark, sf_dir), "customer_nk", _TRACKED, "customer_sk").bindings


def scd2_null_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = (
        F.when(F.col("status") == "P", None)
        .when(F.col("status") == "O", "")
        .otherwise(F.col("priority"))
    )
    snapshots = _yearly(spark, sf_dir).withColumn("priority", blank).drop("status")
    history = scd2_history(snapshots, "customer_nk", ["priority"], "customer_sk")
    return dates_as_text(history)


def scd2_events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("user_nk"),
        "event_type",
        "ts",
        "event_id",
        F.to_date("ts").alias("load_date"),
    )
    first = keep_first(events, ["user_nk", "load_date"], ["ts", "event_id"])
    snapshots = first.drop("ts", "event_id").withColumn("edition_seq", F.unix_date("load_date"))
    return dates_as_text(scd2_history(snapshots, "user_nk", ["event_type"], "user_sk"))


def scd_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _halves(spark, sf_dir)
    existing = scd2_merge(None, first, "customer_nk", _TRACKED, "customer_sk", _HALF_DATES[1])
    changes = classify_changes(existing, second, "customer_nk", _TRACKED)
    return changes.groupBy("change").agg(F.count(F.lit(1)).alias("n"))


def as_of_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = scd2_history(_yearly(spark, sf_dir), "customer_nk", _TRACKED, "customer_sk")
    return _versions(as_of(history, date(1998, 6, 1)))


def as_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = scd2_history(_yearly(spark, sf_dir), "customer_nk", _TRACKED, "customer_sk")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_nk"), F.to_date("o_orderdate").alias("day")
    )
    dated = as_of(orders.join(history, "customer_nk"), F.col("day"))
    return dated.select("o_orderkey", "customer_sk")


def _shared_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the user that they belong to: a shared one, 0, for those of the night, a third of the day."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "ts",
        F.when(F.hour("ts") < 8, 0).otherwise(F.col("user_id")).alias("user_nk"),
        F.to_date("ts").alias("day"),
    )


def as_of_sliced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the version of its user on its day; one user has a third of the rows and a version for most days."""
    events = _shared_events(spark, sf_dir)
    first = keep_first(events, ["user_nk", "day"], ["ts", "event_id"])
    snapshots = first.select(
        "user_nk", F.col("event_type").alias("first_type"), F.col("day").alias("load_date"), F.unix_date("day").alias("edition_seq")
    )
    history = scd2_history(snapshots, "user_nk", ["first_type"], "user_sk")
    dated = as_of_sliced(events, history, "user_nk", "day", slice_days=7, slice_rows=10_000)
    return dates_as_text(dated).select("event_id", "user_nk", "first_type", "valid_from", "valid_to", "is_current")


_YEARLY = customer_snapshots_sql(BY_YEAR_SQL)
_HALVES = customer_snapshots_sql(BY_HALF_SQL)
_YEARLY_VERSIONS = versions_sql(_YEARLY, "customer_nk", _TRACKED, "customer_sk", JAN_FIRST_SQL)
_COLUMNS = versions_columns_sql("customer_nk", _TRACKED, "customer_sk")
_BLANK = f"""SELECT customer_nk, CASE WHEN status = 'P' THEN NULL WHEN status = 'O' THEN ''
                                      ELSE priority END AS priority, edition_seq FROM ({_YEARLY})"""
_DAILY = """SELECT user_id AS user_nk, event_type, edition_seq FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id, edition_seq ORDER BY ts, event_id) AS rn
                FROM (SELECT *, CAST(ts AS DATE) AS edition_seq FROM events))
            WHERE rn = 1"""


_SHARED = "SELECT event_id, event_type, ts, CASE WHEN hour(ts) < 8 THEN 0 ELSE user_id END AS user_nk, CAST(ts AS DATE) AS day FROM events"
_SHARED_DAILY = f"""SELECT user_nk, event_type AS first_type, day AS edition_seq FROM (
                SELECT *, row_number() OVER (PARTITION BY user_nk, day ORDER BY ts, event_id) AS rn FROM ({_SHARED}))
            WHERE rn = 1"""


def _scd0_sql(snapshots: str) -> str:
    return f"""
        WITH snapshots AS ({snapshots}),
        first AS (
            SELECT *, row_number() OVER (PARTITION BY customer_nk ORDER BY edition_seq) AS rn
            FROM snapshots)
        SELECT CAST(row_number() OVER (ORDER BY edition_seq, customer_nk) AS BIGINT) AS customer_sk,
               customer_nk, priority, status
        FROM first WHERE rn = 1"""


def _parts_sql(batch: str) -> str:
    return f"""
        WITH lines AS (
            SELECT l_partkey AS part_nk, l_linestatus AS line_status,
                   nullif(l_returnflag, 'N') AS return_flag,
                   CAST(year(l_shipdate) AS BIGINT) AS ship_year, {batch} AS edition_seq,
                   row_number() OVER (
                       PARTITION BY l_partkey, {batch}
                       ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_linenumber, l_extendedprice,
                                l_suppkey, l_linestatus, nullif(l_returnflag, 'N') NULLS FIRST) AS rn
            FROM lineitem),
        ends AS (
            SELECT *, row_number() OVER (PARTITION BY part_nk ORDER BY edition_seq) AS from_start,
                   row_number() OVER (PARTITION BY part_nk ORDER BY edition_seq DESC) AS from_end
            FROM lines WHERE rn = 1)
        SELECT CAST(row_number() OVER (ORDER BY a.edition_seq, a.part_nk) AS BIGINT) AS part_sk,
               a.part_nk, z.line_status, z.return_flag, a.ship_year
        FROM ends a JOIN ends z ON a.part_nk = z.part_nk AND a.from_start = 1 AND z.from_end = 1"""


QUERIES = {
    "scd0_history": (scd0_history_customers, _scd0_sql(_YEARLY)),
    "scd0_merge": (scd0_merge_customers, _scd0_sql(_HALVES)),
    "scd1_history": (scd1_history_parts, _parts_sql("CAST(year(l_shipdate) AS BIGINT)")),
    "scd1_merge": (
        scd1_merge_parts,
        _parts_sql(f"CASE WHEN year(l_shipdate) < {SPLIT_YEAR} THEN 1 ELSE 2 END"),
    ),
    "scd1_without_keys": (
        scd1_without_keys,
        f"""WITH snapshots AS ({_HALVES})
            SELECT customer_nk, coalesce(b.priority, a.priority) AS priority, a.status
            FROM (SELECT * FROM snapshots WHERE edition_seq = 1) a
            FULL JOIN (SELECT * FROM snapshots WHERE edition_seq = 2) b USING (customer_nk)""",
    ),
    "scd2_first_load": (
        scd2_first_load,
        f"""SELECT CAST(row_number() OVER (ORDER BY customer_nk) AS BIGINT) AS customer_sk,
                   customer_nk, priority, status, '1995-01-01' AS valid_from,
                   '9999-12-31' AS valid_to, true AS is_current
            FROM ({customer_snapshots_sql("1")})""",
    ),
    "scd2_merge": (
        scd2_merge_customers,
        f"""WITH {versions_sql(_HALVES, "customer_nk", _TRACKED, "customer_sk", _HALF_DATE_SQL)}
            SELECT {_COLUMNS} FROM versions""",
    ),
    "scd2_history": (scd2_history_customers, f"WITH {_YEARLY_VERSIONS} SELECT {_COLUMNS} FROM versions"),
    "scd2_bindings": (
        scd2_bindings,
        f"""WITH {_YEARLY_VERSIONS}
            SELECT s.customer_nk, s.edition_seq, v.customer_sk
            FROM snapshots s JOIN versions v
              ON s.customer_nk = v.customer_nk AND v.edition_seq <= s.edition_seq
             AND (v.next_seq IS NULL OR s.edition_seq < v.next_seq)""",
    ),
    "scd2_null_empty": (
        scd2_null_empty,
        f"""WITH {versions_sql(_BLANK, "customer_nk", ["priority"], "customer_sk", JAN_FIRST_SQL)}
            SELECT {versions_columns_sql("customer_nk", ["priority"], "customer_sk")} FROM versions""",
    ),
    "scd2_events_daily": (
        scd2_events_daily,
        f"""WITH {versions_sql(_DAILY, "user_nk", ["event_type"], "user_sk", "{seq}")}
            SELECT {versions_columns_sql("user_nk", ["event_type"], "user_sk")} FROM versions""",
    ),
    "scd_classify": (
        scd_classify,
        f"""WITH snapshots AS ({_HALVES})
            SELECT CASE WHEN a.customer_nk IS NULL THEN 'new'
                        WHEN a.priority <> b.priority OR a.status <> b.status THEN 'changed'
                        ELSE 'unchanged' END AS change, count(*) AS n
            FROM (SELECT * FROM snapshots WHERE edition_seq = 2) b
            LEFT JOIN (SELECT * FROM snapshots WHERE edition_seq = 1) a USING (customer_nk)
            GROUP BY ALL""",
    ),
    "as_of_date": (
        as_of_date,
        f"""WITH {_YEARLY_VERSIONS} SELECT {_COLUMNS} FROM versions
            WHERE valid_from <= DATE '1998-06-01' AND DATE '1998-06-01' < valid_to""",
    ),
    "as_of_sliced": (
        as_of_sliced_events,
        f"""WITH {versions_sql(_SHARED_DAILY, "user_nk", ["first_type"], "user_sk", "{seq}")},
            spans AS (SELECT {versions_columns_sql("user_nk", ["first_type"], "user_sk")} FROM versions)
            SELECT event_id, e.user_nk, d.first_type, d.valid_from, d.valid_to, d.is_current
            FROM ({_SHARED}) e JOIN spans d ON e.user_nk = d.user_nk
             AND CAST(d.valid_from AS DATE) <= e.day AND e.day < CAST(d.valid_to AS DATE)""",
    ),
    "as_of_orders": (
        as_of_orders,
        f"""WITH {_YEARLY_VERSIONS}
            SELECT o_orderkey, customer_sk FROM orders JOIN versions
              ON o_custkey = customer_nk AND valid_from <= CAST(o_orderdate AS DATE)
             AND CAST(o_orderdate AS DATE) < valid_to""",
    ),
}
