import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodeworks.operators import keys
from lodeworks.operators.keys import assign_batch_keys, assign_keys, count_cells, max_key
from tests.conftest import rows


def test_keys_equal_a_global_row_number(spark):
    # One leading value holds most rows, and there are nulls in the order.
    source = spark.range(5000).select(
        F.when(F.col("id") % 10 < 7, 5).otherwise(F.col("id") % 3).alias("lead"),
        F.when(F.col("id") % 11 != 0, F.col("id") * 7919 % 5000).alias("second"),
        "id",
    )
    order = [F.col("lead").desc(), "second", "id"]
    keyed = assign_keys(source.repartition(7), "sk", order, start=100)
    whole = source.withColumn("sk", 100 + F.row_number().over(Window.orderBy(*order)))
    assert rows(keyed, "sk", "id") == rows(whole, "sk", "id")


def test_many_partitions_are_numbered_one_after_another(spark):
    source = spark.range(20000).select((F.col("id") * 7919 % 20000).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        keyed = assign_keys(source, "sk", ["v"])
        assert keyed.filter("sk != v + 1").count() == 0
        assert keyed.count() == 20000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_input_and_column_choice(spark):
    empty = spark.range(0).withColumn("x", F.lit(1))
    keyed = assign_keys(empty, "sk", ["id"], columns=["x"])
    assert keyed.columns == ["sk", "x"]
    assert keyed.count() == 0
    assert max_key(keyed, "sk") == 0 == max_key(None, "sk")


def batches(spark):
    """Batches of very different sizes, one of them absent and one with two thirds of the rows."""
    number = F.when(F.col("id") < 6000, 3).when(F.col("id") < 6010, 1).otherwise(4)
    return spark.range(9000).select(number.alias("b"), "id", (F.col("id") * 3).alias("v"))


def keyed_batches(spark, layout=lambda df: df, start=0):
    source = batches(spark)
    return assign_batch_keys(layout(source), "sk", "b", count_cells(source, "b", F.xxhash64("id")), F.xxhash64("id"), start)


@pytest.fixture()
def small_parts(monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_PART", 700)
    monkeypatch.setattr(keys, "LEAST_ROWS", 1)


def test_batch_keys_are_dense_and_follow_the_batches(spark, small_parts):
    keyed = keyed_batches(spark, start=50)
    spans = keyed.groupBy("b").agg(F.min("sk"), F.max("sk"), F.countDistinct("sk"))
    assert rows(spans) == [(1, 51, 60, 10), (3, 61, 6060, 6000), (4, 6061, 9050, 2990)]
    assert keyed.filter("v != id * 3").count() == 0


def test_batch_keys_do_not_depend_on_the_layout(spark, monkeypatch, small_parts):
    one = rows(keyed_batches(spark, lambda df: df.repartition(5, "v")))
    monkeypatch.setattr(keys, "ROWS_PER_PART", 10**6)
    monkeypatch.setattr(keys, "LEAST_ROWS", 10**6)
    assert one == rows(keyed_batches(spark, lambda df: df.coalesce(1)))


def test_batch_keys_spread_a_dominant_batch_and_stage_nothing(spark, monkeypatch, small_parts):
    monkeypatch.setattr(keys, "stage", None)
    parts = keyed_batches(spark).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 13
    assert max(row["count"] for row in parts) < 2 * 700


def test_few_rows_stay_in_few_partitions(spark):
    assert keyed_batches(spark).rdd.getNumPartitions() == 1


def test_rows_that_were_not_counted_fail(spark, small_parts):
    source = batches(spark)
    counts = count_cells(source.filter("id % 2 = 0"), "b", F.xxhash64("id"))
    with pytest.raises(Exception, match="not counted"):
        assign_batch_keys(source, "sk", "b", counts, F.xxhash64("id")).collect()


def test_no_rows(spark):
    none = batches(spark).filter("id < 0")
    assert assign_batch_keys(none, "sk", "b", count_cells(none, "b", F.xxhash64("id")), F.xxhash64("id")).collect() == []


def test_equal_rows_get_different_keys(spark):
    random.seed(3)
    same = spark.createDataFrame([(1, random.choice("ab")) for _ in range(200)], "b int, v string")
    keyed = assign_batch_keys(same, "sk", "b", count_cells(same, "b", F.xxhash64("v")), F.xxhash64("v"))
    assert sorted(row["sk"] for row in keyed.collect()) == list(range(1, 201))
