import pytest
from pyspark.sql import functions as F

from lodeworks.functions.columns import (
    cast_columns,
    changed_expr,
    edition_order_key,
    load_date_of,
    null_sentinels,
    percent_text,
    rename_columns,
    require_columns,
    trim_columns,
)
from lodeworks.schemas import conform, table_schema
from tests.conftest import rows


def test_rename_ignores_case_and_absent_columns(spark):
    df = spark.createDataFrame([(1, 2)], "ID int, Other int")
    renamed = rename_columns(df, {"id": "key", "absent": "x", "OTHER": "other"})
    assert renamed.columns == ["key", "other"]


def test_lenient_casts(spark):
    texts = ["22", " 7 ", "22.0", "-3.9", "NA", "", None, "1e3", "abc", "9223372036854775808"]
    df = spark.createDataFrame([(text, text) for text in texts], "whole string, real string")
    cast = cast_columns(df, {"whole": "bigint", "real": "double"})
    assert dict(cast.dtypes) == {"whole": "bigint", "real": "double"}
    found = [tuple(row) for row in cast.collect()]
    assert [row[0] for row in found] == [22, 7, 22, -3, None, None, None, None, None, None]
    assert [row[1] for row in found] == [22.0, 7.0, 22.0, -3.9, None, None, None, 1000.0, None, 9223372036854775808.0]


def test_trim_takes_spaces_only(spark):
    df = spark.createDataFrame([("  a b ", "\t c "), (None, "d")], "x string, y string")
    assert rows(trim_columns(df, ["x", "y"])) == [("a b", "\t c"), (None, "d")]


def test_sentinels_and_required_columns(spark):
    df = spark.createDataFrame([("NA", 1), ("Gold", None), (None, 3), ("na", 4)], "medal string, n int")
    clean = null_sentinels(df, {"medal": "NA"})
    assert rows(clean) == [("Gold", None), ("na", 4), (None, 1), (None, 3)]
    assert rows(require_columns(clean, ["medal", "n"])) == [("na", 4)]


@pytest.mark.parametrize(
    ("label", "key"),
    [("1996 Summer", 1996), ("Summer 1996", 0), ("", 0), ("-5 x", 0), ("12a b", 0), ("0007", 7), (None, 0)],
)
def test_edition_order_key(spark, label, key):
    df = spark.createDataFrame([(label,)], "label string")
    assert df.select(edition_order_key(F.col("label"))).first()[0] == key


def test_load_date_and_percent(spark):
    df = spark.createDataFrame([(1996, 0.125)], "year bigint, ratio double")
    row = df.select(load_date_of(F.col("year")).cast("string"), percent_text(F.col("ratio"))).first()
    assert tuple(row) == ("1996-01-01", "12.50%")


def test_change_treats_null_as_empty_text(spark):
    pairs = [("a", "a"), ("a", "b"), (None, ""), (None, None), ("", "a"), ("a", None)]
    df = spark.createDataFrame(pairs, "old string, new string")
    found = [row[0] for row in df.select(changed_expr([(F.col("old"), F.col("new"))])).collect()]
    assert found == [False, True, False, False, True, True]


def test_conform_orders_casts_and_rejects_nulls(spark):
    schema = table_schema({"b": "long", "a": "string"}, not_null=("b",))
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    conformed = conform(df, schema)
    assert conformed.dtypes == [("b", "bigint"), ("a", "string")]
    assert rows(conformed) == [(2, "1")]
    broken = spark.createDataFrame([(1, None)], "a int, b int")
    with pytest.raises(Exception, match="null in NOT NULL column b"):
        conform(broken, schema).collect()
