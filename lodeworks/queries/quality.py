"""Quality checks and constraints over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators.dedupe import dedupe_rows
from lodeworks.operators.quality import (
    AcceptedValues,
    ConstraintError,
    NoNulls,
    NotEmpty,
    Unique,
    check_accepted_values,
    check_no_nulls,
    check_not_empty,
    check_row_count_consistent,
    check_unique,
    enforce_constraints,
    results_frame,
    run_checks,
    unexpected_values,
    write_checked,
)
from lodeworks.queries.tables import table
from lodeworks.sources.tables import staging_path, write_table


def _gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose priority is unknown while their status is P."""
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").withColumn("o_orderpriority", priority)


def not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["orders", "lineitem", "customer", "documents", "events"]
    results = [check_not_empty(table(spark, sf_dir, name), name) for name in names]
    nothing = table(spark, sf_dir, "orders").filter(F.col("o_orderkey").isNull())
    return results_frame(spark, [*results, check_not_empty(nothing, "nothing")])


def no_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    gappy = _gappy_orders(spark, sf_dir)
    return results_frame(
        spark,
        [
            check_no_nulls(gappy, ["o_orderkey", "o_orderpriority", "absent"], "gappy"),
            check_no_nulls(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_tax"], "lineitem"),
        ],
    )


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_frame(
        spark,
        [
            check_unique(table(spark, sf_dir, "orders"), ["o_orderkey"], "orders"),
            check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
            check_unique(table(spark, sf_dir, "documents"), ["text"], "documents"),
        ],
    )


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return results_frame(
        spark,
        [
            check_accepted_values(orders, "o_orderstatus", ["O"], "orders"),
            check_accepted_values(lines, "l_returnflag", ["A", "N", "R", None], "lineitem"),
            check_accepted_values(orders, "o_orderkey", [0], "keys"),
        ],
    )


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    before = documents.count()
    after = dedupe_rows(documents.select("text")).count()
    return results_frame(
        spark,
        [
            check_row_count_consistent(before, after, "documents"),
            check_row_count_consistent(before, after, "tolerant", tolerance=0.5),
            check_row_count_consistent(after, before, "growing"),
            check_row_count_consistent(0, after, "nothing"),
        ],
    )


_ORDER_RULES = [
    NotEmpty(),
    NoNulls(("o_orderkey", "o_custkey", "o_orderpriority")),
    Unique(("o_orderkey",)),
    Unique(("o_custkey",)),
    AcceptedValues("o_orderstatus", ("F", "O", "P")),
    AcceptedValues("o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM")),
]


def rule_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_frame(spark, run_checks(_gappy_orders(spark, sf_dir), "orders", _ORDER_RULES))


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules, measured while the orders are written."""
    orders, path = _gappy_orders(spark, sf_dir), staging_path(spark, "checked")
    _, _, results = write_checked(orders, lambda df: write_table(df, path), "orders", _ORDER_RULES)
    return results_frame(spark, results)


def unexpected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = AcceptedValues("event_type", ("click", None))
    return unexpected_values(table(spark, sf_dir, "events"), rule)


def constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    declared = [
        ("orders", orders, ["o_orderkey", "o_orderdate"], ["o_orderkey"]),
        ("gappy", _gappy_orders(spark, sf_dir), ["o_orderpriority"], []),
        ("lineitem", lines, ["l_orderkey"], ["l_orderkey", "l_linenumber"]),
    ]
    outcome = []
    for name, rows, not_null, key in declared:
        try:
            enforce_constraints(rows, name, not_null, key)
            outcome.append((name, True))
        except ConstraintError:
            outcome.append((name, False))
    return spark.createDataFrame(outcome, "source string, holds boolean")


_GAPPY_SQL = "SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority) FROM orders"


def _not_empty_sql(name: str, source: str) -> str:
    return f"""SELECT '{name}:not_empty' AS check_name, count(*) > 0 AS passed,
                      CAST(count(*) AS VARCHAR) || ' rows' AS details FROM {source}"""


def _unique_sql(name: str, source: str, columns: list[str]) -> str:
    return f"""SELECT '{name}:unique' AS check_name, coalesce(sum(n - 1), 0) = 0 AS passed,
                      CASE WHEN coalesce(sum(n - 1), 0) = 0 THEN 'every key once'
                           ELSE CAST(CAST(sum(n - 1) AS BIGINT) AS VARCHAR) || ' rows repeat the key ['
                                || '{", ".join("''" + c + "''" for c in columns)}' || ']' END AS details
               FROM (SELECT count(*) AS n FROM {source} GROUP BY {", ".join(columns)})"""


def _no_nulls_sql(name: str, source: str, column: str) -> str:
    """For tables in which only *column* may hold nulls."""
    return f"""SELECT '{name}:no_nulls' AS check_name, count(*) = count({column}) AS passed,
                      CASE WHEN count(*) = count({column}) THEN 'every value present'
                           ELSE 'values missing: {{''{column}'': '
                                || CAST(count(*) - count({column}) AS VARCHAR) || '}}' END AS details
               FROM {source}"""


def _accepted_sql(name: str, source: str, column: str, values: str) -> str:
    return f"""SELECT '{name}:accepted_values({column})' AS check_name, count(*) = 0 AS passed,
                      CASE WHEN count(*) = 0 THEN 'only accepted values'
                           ELSE CAST(count(*) AS VARCHAR) || ' rows outside the set, the smallest value is '
                                || CAST(min({column}) AS VARCHAR) END AS details
               FROM (SELECT {column} FROM {source} WHERE {column} NOT IN ({values}))"""


def _row_count_sql(name: str, before: str, after: str, tolerance: str) -> str:
    drop = f"1.0::DOUBLE - {after}::DOUBLE / {before}"
    return f"""SELECT '{name}:row_count_consistent' AS check_name, {drop} <= {tolerance} AS passed,
                      printf('before=%d, after=%d, drop=%.2f%%', {before}, {after}, 100 * ({drop})) AS details
               FROM counts"""


QUERIES = {
    "check_not_empty": (
        not_empty,
        " UNION ALL ".join(
            [_not_empty_sql(n, n) for n in ("orders", "lineitem", "customer", "documents", "events")]
            + [_not_empty_sql("nothing", "orders WHERE o_orderkey IS NULL")]
        ),
    ),
    "check_no_nulls": (
        no_nulls,
        _no_nulls_sql("gappy", f"({_GAPPY_SQL})", "o_orderpriority")
        + " UNION ALL "
        + _no_nulls_sql("lineitem", "lineitem", "l_tax"),
    ),
    "check_unique": (
        unique,
        " UNION ALL ".join(
            [
                _unique_sql("orders", "orders", ["o_orderkey"]),
                _unique_sql("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
                _unique_sql("documents", "documents", ["text"]),
            ]
        ),
    ),
    "check_accepted": (
        accepted,
        " UNION ALL ".join(
            [
                _accepted_sql("orders", "orders", "o_orderstatus", "'O'"),
                _accepted_sql("lineitem", "lineitem", "l_returnflag", "'A', 'N', 'R'"),
                _accepted_sql("keys", "orders", "o_orderkey", "0"),
            ]
        ),
    ),
    "check_row_count": (
        row_count,
        f"""WITH counts AS (SELECT count(*) AS before, count(DISTINCT text) AS after FROM documents)
            {_row_count_sql("documents", "before", "after", "0")} UNION ALL
            {_row_count_sql("tolerant", "before", "after", "0.5")} UNION ALL
            {_row_count_sql("growing", "after", "before", "0")} UNION ALL
            SELECT 'nothing:row_count_consistent', true, 'nothing to compare with'""",
    ),
    "quality_report": (
        rule_set,
        " UNION ALL ".join(
            [
                _not_empty_sql("orders", "orders"),
                _no_nulls_sql("orders", f"({_GAPPY_SQL})", "o_orderpriority"),
                _unique_sql("orders", "orders", ["o_orderkey"]),
                _unique_sql("orders", "orders", ["o_custkey"]),
                _accepted_sql("orders", "orders", "o_orderstatus", "'F', 'O', 'P'"),
                _accepted_sql("orders", f"({_GAPPY_SQL})", "o_orderpriority", "'1-URGENT', '2-HIGH', '3-MEDIUM'"),
            ]
        ),
    ),
    "unexpected_values": (
        unexpected,
        "SELECT event_type, count(*) AS count FROM events WHERE event_type <> 'click' GROUP BY event_type",
    ),
    "constraints": (
        constraints,
        f"""SELECT 'orders' AS source, count(*) = count(DISTINCT o_orderkey) AS holds FROM orders
            UNION ALL SELECT 'gappy', count(*) = count(o_orderpriority) FROM ({_GAPPY_SQL})
            UNION ALL SELECT 'lineitem', count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""",
    ),
}
QUERIES["observed_checks"] = (observed, QUERIES["quality_report"][1])
