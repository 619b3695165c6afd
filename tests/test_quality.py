import pytest
from pyspark.sql import functions as F

from lodeworks.operators import quality
from lodeworks.operators.lineage import lineage_rows, log_lineage, log_steps, read_lineage
from lodeworks.operators.quality import (
    AcceptedValues,
    ConstraintError,
    NoNulls,
    NotEmpty,
    QualityError,
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
from lodeworks.schemas import PIPELINE_LINEAGE
from lodeworks.sources.tables import write_table
from tests.conftest import rows


@pytest.fixture(scope="module")
def table(spark):
    data = [(1, "a", 1.0), (2, None, float("nan")), (2, "b", None), (None, "b", 2.0), (None, "b", 2.0)]
    return spark.createDataFrame(data, "id int, v string, x double")


def test_not_empty(table):
    assert check_not_empty(table, "t") == quality.QualityResult("t:not_empty", True, "5 rows")
    assert check_not_empty(table.filter("false"), "t") == quality.QualityResult("t:not_empty", False, "0 rows")


def test_no_nulls(table):
    result = check_no_nulls(table, ["id", "x", "absent", "v"], "t")
    assert (result.passed, result.details) == (False, "values missing: {'id': 2, 'x': 2, 'v': 1}")
    assert check_no_nulls(table.filter("v = 'a'"), ["id", "v"], "t").details == "every value present"
    assert check_no_nulls(table.filter("false"), ["id"], "t").passed


def test_unique(table):
    assert check_unique(table, ["id"], "t").details == "2 rows repeat the key ['id']"
    assert check_unique(table, ["id", "v"], "t").details == "1 rows repeat the key ['id', 'v']"
    assert check_unique(table.filter("v = 'a'"), ["id"], "t").passed
    assert check_unique(table.filter("false"), ["id"], "t").details == "every key once"


def test_accepted_values(table):
    assert check_accepted_values(table, "v", {"a", "b", None}, "t").details == "only accepted values"
    result = check_accepted_values(table, "v", {"a"}, "t")
    assert (result.check_name, result.passed) == ("t:accepted_values(v)", False)
    assert result.details == "3 rows outside the set, the smallest value is b"
    assert check_accepted_values(table, "id", {1}, "t").details == "2 rows outside the set, the smallest value is 2"
    with pytest.raises(Exception, match="absent"):
        check_accepted_values(table, "absent", {1}, "t")


def test_many_unexpected_values_stay_distributed(spark):
    ids = spark.range(500)
    result = check_accepted_values(ids, "id", {0}, "t")
    assert result.details == "499 rows outside the set, the smallest value is 1"
    assert unexpected_values(ids, AcceptedValues("id", (0,))).count() == 499


@pytest.mark.parametrize(
    ("before", "after", "tolerance", "passed", "details"),
    [
        (100, 100, 0.0, True, "before=100, after=100, drop=0.00%"),
        (100, 50, 0.0, False, "before=100, after=50, drop=50.00%"),
        (100, 95, 0.1, True, "before=100, after=95, drop=5.00%"),
        (100, 150, 0.0, True, "before=100, after=150, drop=-50.00%"),
        (0, 5, 0.0, True, "nothing to compare with"),
    ],
)
def test_row_count_consistent(before, after, tolerance, passed, details):
    result = check_row_count_consistent(before, after, "t", tolerance)
    assert (result.check_name, result.passed, result.details) == ("t:row_count_consistent", passed, details)


def test_checks_run_together_and_can_fail(spark, table):
    checks = [NotEmpty(), NoNulls(("id",)), Unique(("id", "v", "x")), AcceptedValues("v", ("a", "b"))]
    results = run_checks(table, "t", checks)
    assert [result.passed for result in results] == [True, False, False, True]
    assert results_frame(spark, results).columns == ["check_name", "passed", "details"]
    with pytest.raises(QualityError, match="t:no_nulls: values missing"):
        run_checks(table, "t", checks, fail=True)


def test_one_pass_for_all_counting_checks(spark, table, monkeypatch):
    calls = []
    plain = type(table).agg
    monkeypatch.setattr(type(table), "agg", lambda self, *exprs: calls.append(exprs) or plain(self, *exprs))
    run_checks(table, "t", [NotEmpty(), NoNulls(("id", "v")), AcceptedValues("v", ("a", "b"))])
    assert len(calls) == 1


def test_constraints(table):
    valid = table.filter("id = 1")
    assert enforce_constraints(valid, "t", ["id"], ["id"]) is valid
    with pytest.raises(ConstraintError, match="no_nulls"):
        enforce_constraints(table, "t", ["id"])
    with pytest.raises(ConstraintError, match="unique"):
        enforce_constraints(table, "t", primary_key=["v"])


def test_lineage(spark, tmp_path):
    path = str(tmp_path / "lineage")
    assert read_lineage(spark, path).count() == 0
    log_lineage(spark, path, "bronze", "raw/x.csv", "bronze/x", 1000)
    log_steps(spark, path, [("silver", "bronze/x", "silver/x", 90, "success"), ("gold", "s", "g", 0, "failure")])
    found = read_lineage(spark, path)
    assert found.schema.names == PIPELINE_LINEAGE.names
    assert rows(found.drop("run_timestamp")) == [
        (1, "bronze", "raw/x.csv", "bronze/x", 1000, "success"),
        (2, "silver", "bronze/x", "silver/x", 90, "success"),
        (3, "gold", "s", "g", 0, "failure"),
    ]
    assert found.filter(F.col("run_timestamp").isNull()).count() == 0
    assert dict(found.dtypes)["run_timestamp"] == "timestamp_ntz"
    assert rows(lineage_rows(spark, [("a", "b", "c", 1, "success")], 41), "lineage_id") == [(42,)]


def test_checks_and_counts_come_from_the_write(spark, tmp_path, monkeypatch):
    data = spark.createDataFrame([(1, "a"), (2, None), (2, "c"), (None, "a")], "id long, v string").repartition(3)
    rules = [NotEmpty(), NoNulls(("id", "v", "absent")), AcceptedValues("v", ("a", "b"))]
    expected = run_checks(data, "t", rules)
    plans = []

    def write(df):
        plans.append(df._jdf.queryExecution().toString())
        return write_table(df, str(tmp_path / "t"))

    with monkeypatch.context() as patched:
        # Nothing is aggregated besides: one pass writes, counts and checks.
        patched.setattr("pyspark.sql.classic.dataframe.DataFrame.agg", None)
        patched.setattr("pyspark.sql.classic.dataframe.DataFrame.count", None)
        written, n_rows, results = write_checked(data, write, "t", rules)
    assert (n_rows, results) == (4, expected)
    assert written.count() == 4
    assert "CollectMetrics" in plans[0]
    again = write_checked(data, write, "t", [*rules, Unique(("id",))])[2]
    assert again == run_checks(data, "t", [*rules, Unique(("id",))])
    with pytest.raises(QualityError, match="accepted_values"):
        write_checked(data, write, "t", rules, fail=True)
    empty = write_checked(data.filter("false"), write, "t", rules)
    assert (empty[1], empty[2][0].passed) == (0, False)
