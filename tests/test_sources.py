import os
import time
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from lodeworks.schemas import table_schema
from lodeworks.sources.tables import (
    append_rows,
    freed_after,
    ingest_csv,
    read_table_or_empty,
    stage,
    stage_in_turn,
    staging_path,
    staging_root,
    write_table,
)
from tests.conftest import rows

CSV = 'ID,Name,NOC\n1,"Ann ""Fast"" Ray",AAA\n2,"Bo\nDi",BBB\n3,,CCC\n'


@pytest.fixture()
def raw(tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV)
    return path


def test_ingest_copies_everything(spark, raw, tmp_path):
    out = tmp_path / "deep" / "bronze"
    assert ingest_csv(spark, raw, out) == 3
    assert (out / "_SUCCESS").exists()
    table = spark.read.parquet(str(out))
    assert table.dtypes == [("ID", "int"), ("Name", "string"), ("NOC", "string")]
    assert rows(table) == [(1, 'Ann "Fast" Ray', "AAA"), (2, "Bo\nDi", "BBB"), (3, None, "CCC")]


def test_ingest_again_replaces(spark, raw, tmp_path):
    for _ in range(2):
        assert ingest_csv(spark, raw, tmp_path / "bronze") == 3


def test_ingest_folder_with_schema(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for number in range(3):
        (folder / f"{number}.csv").write_text(f"a,b\n{number},x\n")
    schema = table_schema({"a": "long", "b": "string"}, ())
    assert ingest_csv(spark, folder, tmp_path / "out", schema, multi_line=False) == 3
    assert spark.read.parquet(str(tmp_path / "out")).dtypes == [("a", "bigint"), ("b", "string")]


def test_one_file_is_read_by_many_tasks_without_multi_line(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("a,b\n" + "".join(f"{n},text {n}\n" for n in range(20_000)))
    schema = table_schema({"a": "long", "b": "string"}, ())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        assert ingest_csv(spark, path, tmp_path / "split", schema, multi_line=False) == 20_000
        assert ingest_csv(spark, path, tmp_path / "whole", schema) == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    split, whole = (len(list((tmp_path / name).glob("part-*"))) for name in ("split", "whole"))
    assert split > 5 and whole == 1
    assert rows(spark.read.parquet(str(tmp_path / "split"))) == rows(spark.read.parquet(str(tmp_path / "whole")))


def test_only_a_missing_table_is_empty(spark, tmp_path):
    schema = table_schema({"a": "long"}, ())
    assert read_table_or_empty(spark, tmp_path / "none", schema).count() == 0
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_table_or_empty(spark, broken, schema).collect()


def test_append_and_overwrite(spark, tmp_path):
    first = spark.createDataFrame([(1, "x")], "a long, p string")
    second = spark.createDataFrame([(2, "y")], "a long, p string")
    path = str(tmp_path / "table")
    append_rows(first, path, ["p"])
    append_rows(second, path, ["p"])
    stored = read_table_or_empty(spark, path, table_schema({"p": "string", "a": "long"}, ()))
    assert stored.columns == ["p", "a"]
    assert rows(stored) == [("x", 1), ("y", 2)]
    assert rows(write_table(second, path)) == [(2, "y")]


def test_staging_uses_the_checkpoint_folder(spark):
    root = staging_root(spark)
    assert root.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert spark.sparkContext.applicationId in root
    staged = stage(spark.range(5), "numbers")
    assert root in staged.inputFiles()[0]
    assert staged.count() == 5


def test_staged_tables_are_freed_also_after_a_failure(spark):
    outside = stage(spark.range(3), "kept")
    folders = []
    with pytest.raises(ValueError), freed_after(spark, "load"):
        with freed_after(spark, "inner"):
            folders.append(stage(spark.range(5), "numbers").inputFiles()[0])
        folders.append(stage(spark.range(5), "numbers").inputFiles()[0])
        raise ValueError
    assert len(folders) == 2
    assert not any(Path(urlparse(folder).path).exists() for folder in folders)
    assert outside.count() == 3
    assert staging_path(spark, "next").startswith(f"{staging_root(spark)}/next-")


def test_shuffle_files_go_with_their_query(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    to_java = spark._jvm.scala.jdk.javaapi.CollectionConverters
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")

    def shuffled():
        names = (f.getName() for f in to_java.asJava(files.getAllFiles()))
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffled()
    grouped = spark.range(1000).selectExpr("id % 10 AS k", "id").groupBy("k").agg(F.sum("id").alias("n"))
    staged = stage(grouped, "sums")
    until = time.time() + 20
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert staged.count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept


def test_steps_are_staged_in_turn(spark):
    held = []

    def step(rows):
        held.append(rows.inputFiles())
        return rows.withColumn("id", F.col("id") + 1)

    found = stage_in_turn(spark.range(5), "steps", [step, step, step])
    assert rows(found) == [(k,) for k in range(3, 8)]
    assert held[0] == [] and held[1] and held[2]
    assert not any(os.path.exists(f.removeprefix("file://")) for f in held[1] + held[2])
    assert rows(stage_in_turn(spark.range(2), "none", [])) == [(0,), (1,)]
