"""What Spark plans for the operators: skew, pruning, pushdown, and nothing that cannot scale."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lodeworks.operators.dedupe import dedupe_rows, keep_first
from lodeworks.operators.facts import Lookup, fact_history, resolve_keys
from lodeworks.operators.scd import as_of
from lodeworks.plans.reports import count_by_entity
from lodeworks.schemas import table_schema
from lodeworks.sources.gold import Gold, Merged
from tests.conftest import rows
from lodeworks.sources.tables import stage


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture()
def conf(spark):
    changed = {}

    def change(**settings):
        for name, value in settings.items():
            name = "spark.sql." + name.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        spark.conf.set(name, value)


def test_keep_first_limits_every_key_before_the_shuffle(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", "o_orderdate")
    text = plan(keep_first(orders, ["o_custkey"], ["o_orderdate"]))
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.index("Final") < physical.index("Exchange") < physical.index("Partial")
    assert physical.count("Exchange") == 1


def test_a_hot_key_keeps_its_first_row(spark):
    # Two thirds of all rows share one key.
    key = F.when(F.col("id") % 3 < 2, -1).otherwise(F.col("id"))
    kept = keep_first(spark.range(0, 90000, 1, 6).select(key.alias("k"), "id"), ["k"], ["id"])
    assert kept.filter("k = -1").collect() == [(-1, 0)]
    assert kept.count() == 30001


def test_copies_collapse_before_the_shuffle(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang")
    physical = plan(dedupe_rows(documents))
    physical = physical[physical.index("== Physical Plan ==") :]
    assert physical.count("HashAggregate") == 2
    assert physical.index("HashAggregate") < physical.index("Exchange") < physical.rindex("HashAggregate")


def test_hot_fact_keys_are_split(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__parallelismFirst="false",
        shuffle__partitions="8",
    )
    dimension = stage(spark.range(20000).select(F.col("id").alias("nk"), (F.col("id") + 1).alias("sk")), "dim")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20000)
    events = stage(spark.range(0, 120000, 1, 8).select(key.alias("nk"), "id"), "events")
    facts = resolve_keys(events, [Lookup(dimension, ("nk",))])
    found = facts.collect()
    assert len(found) == 120000
    assert all(row["sk"] == row["nk"] + 1 for row in found)
    assert "SortMergeJoin(skew=true)" in plan(facts)


def test_large_dimensions_are_not_broadcast_and_small_ones_are(spark, conf):
    dimension = stage(spark.range(1000).select(F.col("id").alias("nk"), F.col("id").alias("sk")), "dim")
    facts = resolve_keys(spark.range(5000).select((F.col("id") % 1000).alias("nk")), [Lookup(dimension, ("nk",))])
    assert "BroadcastHashJoin" in plan(facts)
    conf(autoBroadcastJoinThreshold="1KB")
    large = resolve_keys(spark.range(5000).select((F.col("id") % 1000).alias("nk")), [Lookup(dimension, ("nk",))])
    assert "SortMergeJoin" in plan(large)


def test_counts_per_entity_are_aggregated_before_the_join(spark, conf, sf):
    conf(autoBroadcastJoinThreshold="-1")
    facts = spark.read.parquet(f"{sf}/orders.parquet")
    dimension = spark.read.parquet(f"{sf}/customer.parquet").withColumnRenamed("c_custkey", "o_custkey")
    text = plan(count_by_entity(facts, dimension, "o_custkey", "o_orderstatus", ["c_name"], "n"))
    physical = text[text.index("== Physical Plan ==") :]
    join = physical.index("SortMergeJoin")
    assert physical[join:].count("HashAggregate") == 2
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in physical
    assert "ReadSchema: struct<o_custkey:bigint" in physical


def test_versions_of_a_day_are_pushed_to_the_scan(spark, conf, tmp_path):
    conf(maxMetadataStringLength="1000")
    versions = spark.sql("SELECT 1L AS sk, DATE'2000-01-01' AS valid_from, DATE'9999-12-31' AS valid_to")
    versions.write.parquet(str(tmp_path / "dim"))
    text = plan(as_of(spark.read.parquet(str(tmp_path / "dim")), F.lit("2001-05-05").cast("date")))
    assert "LessThanOrEqual(valid_from,2001-05-05)" in text
    assert "GreaterThan(valid_to,2001-05-05)" in text


@pytest.mark.parametrize(
    "name",
    ["scd0_history", "scd1_history", "scd2_history", "scd2_bindings", "dim_part", "dense_keys",
     "clean_orders", "as_of_orders", "leaderboard_career", "fact_unmatched", "dim_customer"],
)
def test_nothing_in_the_plan_is_global(spark, sf, name, monkeypatch):
    """No cross join, no unpartitioned window, no Python worker: in the result and in all it stages."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans = []
    write = DataFrameWriter.parquet

    def recorded(writer, *args, **kwargs):
        plans.append(plan(writer._df))
        return write(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    plans.append(plan(queries()[name](spark, sf)))
    for text in plans:
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "Python", "ArrowEval"):
            assert unwanted not in text


def test_the_first_delta_of_a_merged_table_is_not_shuffled(spark, tmp_path):
    gold = Gold(spark, str(tmp_path))
    merged = Merged("dim", table_schema({"k": "long", "v": "string"}, ("k",)), "k")
    for load_id, first in ((1, 0), (2, 900), (3, 950)):
        rows = spark.range(first, 1000).select(F.col("id").alias("k"), F.lit(f"load {load_id}").alias("v"))
        gold.write_delta(merged, rows, load_id)
        gold.publish(load_id, load_id == 1, 0)
    found = gold.read_merged(merged)
    assert {row["v"]: row["count"] for row in found.groupBy("v").count().collect()} == {
        "load 1": 900, "load 2": 50, "load 3": 50,
    }
    text = plan(found)
    physical = text[text.index("== Physical Plan ==") :]
    join = physical.index("LeftAnti")
    assert "BroadcastHashJoin" in physical
    assert "hashpartitioning" not in physical[join : physical.index("FileScan")]
    # A compacted table is read as it is.
    gold.compact([merged])
    assert "Join" not in plan(gold.read_merged(merged)) and "Exchange" not in plan(gold.read_merged(merged))
    assert gold.read_merged(merged).count() == 1000


def test_facts_are_joined_with_large_tables_before_they_are_numbered(spark):
    """One after another, so that the shuffles of one join are on disk at a time; nothing is staged for broadcasts."""
    events = spark.range(300).selectExpr("id", "id % 3 + 1 AS edition_seq", "id % 7 AS a", "CASE WHEN id % 5 > 0 THEN id % 5 END AS b")
    lookups = [
        Lookup(spark.range(6).selectExpr("id AS a", "id + 10 AS a_sk"), ("a",)),
        Lookup(spark.range(20).selectExpr("id % 5 AS b", "id div 5 AS edition_seq", "id + 50 AS b_sk"), ("b", "edition_seq")),
    ]
    threshold, found = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    try:
        for size in ("-1", threshold):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
            facts = fact_history(events, lookups, "sk", ["id", "a_sk", "b_sk"], F.xxhash64("id"))
            found.append(rows(facts))
            assert ("Join" in facts._jdf.queryExecution().optimizedPlan().toString()) == (size == threshold)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found[0] == found[1]
    assert sorted(r[0] for r in found[0]) == list(range(1, 301))
