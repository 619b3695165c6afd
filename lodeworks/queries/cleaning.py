"""Ingest, cleaning, duplicates, keys and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.functions.columns import (
    cast_columns,
    edition_order_key,
    null_sentinels,
    percent_text,
    rename_columns,
    require_columns,
    trim_columns,
)
from lodeworks.operators.dedupe import dedupe_rows, keep_first
from lodeworks.operators.keys import assign_keys, max_key
from lodeworks.plans.cleaning import CleaningSpec, clean_table, clean_to_silver
from lodeworks.queries.tables import SPLIT_YEAR, dates_as_text, table
from lodeworks.schemas import conform, table_schema
from lodeworks.sources.tables import (
    append_rows,
    ingest_csv,
    read_table_or_empty,
    staging_path,
    write_table,
)

_DOCUMENT_TYPES = {"doc_id": "bigint", "n_chars": "bigint"}

_ORDER_CLEANING = CleaningSpec(
    renames={"KEY": "order_key", "CUST": "customer", "TOTAL": "total", "PRIORITY": "priority",
             "STATUS": "status"},
    casts={"order_key": "bigint", "customer": "bigint", "total": "double"},
    trims=("priority",),
    sentinels={"status": "P"},
)


def _dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw text: unknown totals, and every row a second time with a padded priority."""
    orders = table(spark, sf_dir, "orders")
    raw = orders.select(
        F.col("o_orderkey").cast("string").alias("KEY"),
        F.col("o_custkey").cast("string").alias("CUST"),
        F.when(F.col("o_orderstatus") == "P", "NA")
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .alias("TOTAL"),
        F.col("o_orderpriority").alias("PRIORITY"),
        F.col("o_orderstatus").alias("STATUS"),
    )
    padded = raw.withColumn("PRIORITY", F.concat(F.lit("  "), "PRIORITY", F.lit(" ")))
    return raw.unionByName(padded)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, bronze = staging_path(spark, "csv"), staging_path(spark, "bronze")
    documents = table(spark, sf_dir, "documents")
    documents.write.options(header=True, quoteAll=True, escape='"').csv(raw)
    ingest_csv(spark, raw, bronze)
    return cast_columns(spark.read.parquet(bronze), _DOCUMENT_TYPES)


def csv_ingest_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, bronze = staging_path(spark, "csv"), staging_path(spark, "bronze")
    lines = table(spark, sf_dir, "lineitem")
    lines.write.options(header=True).csv(raw)
    rows = ingest_csv(spark, raw, bronze)
    return spark.read.parquet(bronze).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.lit(rows).cast("bigint").alias("ingested")
    )


def csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single-line records, which let every file be read by several tasks, with declared types."""
    raw, bronze = staging_path(spark, "csv"), staging_path(spark, "bronze")
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    orders.write.options(header=True, quoteAll=True, escape='"').csv(raw)
    ingest_csv(spark, raw, bronze, orders.schema, multi_line=False)
    return spark.read.parquet(bronze)


def parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "overwritten")
    write_table(table(spark, sf_dir, "supplier"), path)
    return write_table(table(spark, sf_dir, "customer"), path)


def append_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("bigint").alias("order_year")
    )
    path = staging_path(spark, "appended")
    early = F.col("order_year") < SPLIT_YEAR
    before = read_table_or_empty(spark, path, orders.schema)
    append_rows(orders.filter(early), path, ["order_year"])
    append_rows(orders.filter(~early), path, ["order_year"])
    stored = read_table_or_empty(spark, path, orders.schema)
    counted = stored.groupBy("order_year").agg(F.count(F.lit(1)).alias("n"))
    empty = before.agg(F.lit(0).cast("bigint").alias("order_year"), F.count(F.lit(1)).alias("n"))
    return counted.unionByName(empty)


def rename_cast_na(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _dirty_orders(spark, sf_dir).select("KEY", "TOTAL", "CUST")
    renamed = rename_columns(raw, {"key": "order_key", "TOTAL": "total", "CUST": "customer", "GONE": "x"})
    return cast_columns(renamed, {"order_key": "bigint", "customer": "bigint", "total": "double"})


def trim_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    tab = F.concat(F.lit("\t"), "o_orderpriority", F.lit(" ")).alias("with_tab")
    padded = F.concat(F.lit("  "), "o_orderpriority", F.lit("   ")).alias("padded")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", padded, tab)
    return trim_columns(orders, ["padded", "with_tab"])


def null_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return null_sentinels(lines, {"l_returnflag": "N"})


def require_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderpriority"
    )
    return require_columns(orders, ["status", "o_orderpriority"])


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_table(_dirty_orders(spark, sf_dir), _ORDER_CLEANING)


def clean_orders_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, silver = staging_path(spark, "bronze"), staging_path(spark, "silver")
    read = write_table(_dirty_orders(spark, sf_dir), bronze).count()
    kept = clean_to_silver(spark, bronze, silver, _ORDER_CLEANING)
    # Cleaning is row by row up to the removal of duplicates, so the difference is what it removed.
    return spark.read.parquet(silver).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.lit(read - kept).cast("bigint").alias("removed")
    )


def clean_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("NOC"),
        F.col("c_name").alias("region"),
        F.lit(None).cast("string").alias("notes"),
    )
    spec = CleaningSpec(renames={"NOC": "noc"}, trims=("noc",), unique_by=("noc",))
    return clean_table(customers, spec)


def dedupe_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("text", "lang", "source", "n_chars")
    return dedupe_rows(documents)


def keep_first_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("text", "doc_id", "lang", "source")
    return keep_first(documents, ["text"], ["doc_id"])


def edition_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate").cast("string")
    label = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Year "), year)).otherwise(
        F.concat(year, F.lit(" "), "o_orderstatus")
    )
    orders = table(spark, sf_dir, "orders").select(label.alias("edition"))
    editions = orders.groupBy("edition").agg(F.count(F.lit(1)).alias("n_orders"))
    keyed = editions.withColumn("order_key", edition_order_key(F.col("edition")))
    return assign_keys(keyed, "edition_seq", ["order_key", "edition"])


def dense_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.col("l_shipdate").cast("date").cast("string")
    lines = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", shipped)
    return assign_keys(lines, "line_sk", lines.columns, 1000)


def largest_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    tops = [
        ("orders", max_key(orders, "o_orderkey")),
        ("none", max_key(orders.filter(F.col("o_orderkey").isNull()), "o_orderkey")),
    ]
    return spark.createDataFrame(tops, "source string, top bigint")


def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table_schema(
        {"o_orderdate": "date", "o_orderkey": "integer", "o_custkey": "string"}, ("o_orderkey",)
    )
    return dates_as_text(conform(table(spark, sf_dir, "orders"), schema))


def concat_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party"), F.col("c_name").alias("name"), "c_mktsegment"
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("party")
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    early = F.year("o_orderdate") < SPLIT_YEAR
    known = orders.filter(early).select("o_custkey").distinct()
    incoming = orders.filter(~early).select("o_custkey").distinct()
    both = incoming.join(known, "o_custkey", "left_semi").withColumn("found", F.lit("known"))
    unseen = incoming.join(known, "o_custkey", "left_anti").withColumn("found", F.lit("unseen"))
    return both.unionByName(unseen)


def share_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").count()
    totals = counts.groupBy("l_returnflag").agg(
        F.sum("count").alias("n"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("count")).otherwise(0)).alias("n_open"),
    )
    return totals.select("l_returnflag", percent_text(F.col("n_open") / F.col("n")).alias("open_share"))


_DIRTY_SQL = """
    SELECT o_orderkey AS order_key, o_custkey AS customer,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS total,
           o_orderpriority AS priority, nullif(o_orderstatus, 'P') AS status
    FROM orders"""

_CLEAN_SQL = f"SELECT DISTINCT * FROM ({_DIRTY_SQL} UNION ALL {_DIRTY_SQL})"

QUERIES = {
    "csv_roundtrip": (csv_roundtrip, "SELECT doc_id, text, lang, source, n_chars FROM documents"),
    "csv_ingest_count": (
        csv_ingest_count,
        """SELECT l_returnflag, count(*) AS n, (SELECT count(*) FROM lineitem) AS ingested
           FROM lineitem GROUP BY l_returnflag""",
    ),
    "csv_split": (
        csv_split,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    ),
    "parquet_overwrite": (
        parquet_overwrite,
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    ),
    "append_and_read": (
        append_and_read,
        """SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, count(*) AS n FROM orders
           GROUP BY ALL UNION ALL SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT)""",
    ),
    "rename_cast_na": (
        rename_cast_na,
        f"""SELECT order_key, total, customer FROM ({_DIRTY_SQL})
            UNION ALL SELECT order_key, total, customer FROM ({_DIRTY_SQL})""",
    ),
    "trim_strings": (
        trim_strings,
        r"""SELECT o_orderkey, trim('  ' || o_orderpriority || '   ', ' ') AS padded,
                   trim(chr(9) || o_orderpriority || ' ', ' ') AS with_tab
            FROM orders""",
    ),
    "null_sentinel": (
        null_sentinel,
        """SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem""",
    ),
    "require_columns": (
        require_values,
        """SELECT o_orderkey, o_orderstatus AS status, o_orderpriority FROM orders
           WHERE o_orderstatus <> 'P'""",
    ),
    "clean_orders": (clean_orders, _CLEAN_SQL),
    "clean_orders_removed": (
        clean_orders_removed,
        f"""SELECT status, count(*) AS n, (SELECT count(*) FROM orders) AS removed
            FROM ({_CLEAN_SQL}) GROUP BY status""",
    ),
    "clean_regions": (
        clean_regions,
        """SELECT c_mktsegment AS noc, min(c_name) AS region, CAST(NULL AS VARCHAR) AS notes
           FROM customer GROUP BY c_mktsegment""",
    ),
    "dedupe_documents": (dedupe_documents, "SELECT DISTINCT text, lang, source, n_chars FROM documents"),
    "keep_first_text": (
        keep_first_text,
        """SELECT text, doc_id, lang, source FROM (
               SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
           WHERE rn = 1""",
    ),
    "edition_order": (
        edition_order,
        """WITH labels AS (
               SELECT CASE WHEN o_orderstatus = 'P' THEN 'Year ' || CAST(year(o_orderdate) AS VARCHAR)
                           ELSE CAST(year(o_orderdate) AS VARCHAR) || ' ' || o_orderstatus END AS edition
               FROM orders),
           editions AS (
               SELECT edition, count(*) AS n_orders,
                      CASE WHEN regexp_full_match(split_part(edition, ' ', 1), '[0-9]+')
                           THEN CAST(split_part(edition, ' ', 1) AS BIGINT) ELSE 0 END AS order_key
               FROM labels GROUP BY edition)
           SELECT CAST(row_number() OVER (ORDER BY order_key, edition) AS BIGINT) AS edition_seq,
                  edition, n_orders, order_key
           FROM editions""",
    ),
    "dense_keys": (
        dense_keys,
        """SELECT CAST(1000 + row_number() OVER (
                      ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                               l_shipdate) AS BIGINT) AS line_sk,
                  * REPLACE (CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate)
           FROM lineitem""",
    ),
    "largest_key": (
        largest_key,
        """SELECT 'orders' AS source, coalesce(max(o_orderkey), 0) AS top FROM orders
           UNION ALL SELECT 'none', coalesce(max(o_orderkey), 0) FROM orders WHERE o_orderkey IS NULL""",
    ),
    "conform_orders": (
        conform_orders,
        """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
                  CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey
           FROM orders""",
    ),
    "concat_by_name": (
        concat_by_name,
        """SELECT c_custkey AS party, c_name AS name, c_mktsegment FROM customer
           UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
    ),
    "key_sets": (
        key_sets,
        f"""WITH known AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) < {SPLIT_YEAR}),
                 incoming AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) >= {SPLIT_YEAR})
            SELECT o_custkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM known)
                                   THEN 'known' ELSE 'unseen' END AS found
            FROM incoming""",
    ),
    "share_of_lines": (
        share_of_lines,
        """SELECT l_returnflag,
                  printf('%.2f%%', 100.0 * count(*) FILTER (WHERE l_linestatus = 'O') / count(*)) AS open_share
           FROM lineitem GROUP BY l_returnflag""",
    ),
}
