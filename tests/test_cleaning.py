"""Bronze to silver on a hand-made file with dirt of every kind."""

import pytest

from lodeworks.operators.dedupe import dedupe_rows, keep_first
from lodeworks.plans.cleaning import clean_athlete_events, clean_noc_regions
from tests.conftest import rows

NAMES = "ID int, Name string, Sex string, Age string, Height string, Weight string, Team string, NOC string, Games string, Year int, Season string, City string, Sport string, Event string, Medal string"
RAW = [
    (7, "Eve", "F", "31", "170", "60", "Reds  ", "AAA", "1996 Summer", 1996, "Summer", "Here", "Golf", "Open", "Gold"),
    (7, "Eve", "F", "31", "170", "60", " Reds", "AAA", "1996 Summer", 1996, "Summer", "Here", "Golf", "Open", "Gold"),
    (8, "Fay", "F", "NA", "NA", "55.5", "Blues", " BBB", "1996 Summer", 1996, "Summer", "Here", "Golf", "Open", "NA"),
    (9, "Gus", "M", "40", "181", "NA", "Blues", "BBB", "1998 Winter", 1998, "Winter", "There", "Luge", "Run", None),
]


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cleaning")
    spark.createDataFrame(RAW, NAMES).write.parquet(str(root / "bronze"))
    count = clean_athlete_events(spark, root / "bronze", root / "silver")
    return count, spark.read.parquet(str(root / "silver"))


def test_columns_are_renamed(silver):
    assert silver[1].columns == [
        "athlete_id", "name", "sex", "age", "height", "weight", "team", "noc", "games", "year",
        "season", "city", "sport", "event", "medal",
    ]


def test_numbers_are_cast_and_unknown_ones_null(silver):
    types = dict(silver[1].dtypes)
    assert [types[name] for name in ("athlete_id", "year", "age")] == ["bigint", "bigint", "double"]
    assert rows(silver[1], "athlete_id", "age", "height", "weight") == [
        (7, 31.0, 170.0, 60.0), (8, None, None, 55.5), (9, 40.0, 181.0, None),
    ]


def test_text_is_trimmed_and_medal_marker_is_null(silver):
    assert rows(silver[1], "team", "noc", "medal") == [
        ("Blues", "BBB", None), ("Blues", "BBB", None), ("Reds", "AAA", "Gold"),
    ]


def test_rows_equal_after_trimming_are_merged(silver):
    assert silver[0] == 3 == silver[1].count()


def test_regions_are_renamed_and_unique(spark, tmp_path):
    raw = [("AAA", "Aland", None), ("BBB ", "Bland", None), ("BBB", "Bland", None), ("CCC", None, "x")]
    spark.createDataFrame(raw, "NOC string, region string, notes string").write.parquet(str(tmp_path / "b"))
    assert clean_noc_regions(spark, tmp_path / "b", tmp_path / "s") == 3
    silver = spark.read.parquet(str(tmp_path / "s"))
    assert rows(silver) == [("AAA", "Aland", None), ("BBB", "Bland", None), ("CCC", None, "x")]


def test_dedupe_counts_nulls_and_nans_as_equal(spark):
    nan = float("nan")
    df = spark.createDataFrame([(None, nan), (None, nan), ("a", 1.0)], "x string, y double")
    assert dedupe_rows(df).count() == 2


def test_keep_first_does_not_depend_on_row_order(spark):
    data = [(1, "b", 2), (1, "a", 3), (1, None, 9), (2, "z", 1)]
    for rotation in range(4):
        df = spark.createDataFrame(data[rotation:] + data[:rotation], "k int, v string, n int")
        assert rows(keep_first(df.repartition(3), ["k"], ["v", "n"])) == [(1, None, 9), (2, "z", 1)]
