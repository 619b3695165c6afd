"""Reading and writing tables: CSV in, Parquet in and out, and staged intermediate results."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_SCOPE = "lodeworks.staging.folder"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_root(spark: SparkSession) -> str:
    """The folder for staged tables: a subfolder, per application, of the cluster's checkpoint folder.

    Without a configured checkpoint folder only a local session gets one, below its warehouse;
    on a cluster that path may be local to one machine, so it is an error.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = spark.conf.get("spark.sql.warehouse.dir") + "/staged"
    return f"{shared.rstrip('/')}/lodeworks/{app}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the staging folder, or below that of the surrounding :func:`freed_after`."""
    root = spark.sparkContext.getLocalProperty(_SCOPE) or staging_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def _delete(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def freed_after(spark: SparkSession, name: str) -> Iterator[None]:
    """Delete at the end, also after a failure, what is staged within; shuffle files go with their queries.

    Threads that inherit local properties take part. Nothing lazy that reads staged tables may leave.
    """
    context = spark.sparkContext
    outer = context.getLocalProperty(_SCOPE)
    folder = staging_path(spark, name)
    context.setLocalProperty(_SCOPE, folder)
    try:
        with shuffles_freed(spark):
            yield
    finally:
        context.setLocalProperty(_SCOPE, outer)
        _delete(spark, folder)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write *df* once to shared storage and continue from the written table.

    This cuts the lineage (nothing upstream is computed again when an executor is lost) and gives
    Catalyst the real size of the data, so that it chooses broadcast joins from a known size. Filters on
    columns of *partition_by* read only what they keep.
    """
    return _staged(df, staging_path(df.sparkSession, name), partition_by)


def _staged(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    spark = df.sparkSession
    with shuffles_freed(spark):
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return read_table(spark, df.schema, path)


def stage_in_turn(df: DataFrame, name: str, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply the *steps* one after another, each staged.

    Only the shuffles of one step are on disk at a time, and a step's table goes when the next one is written.
    """
    last = None
    for step in steps:
        path = staging_path(df.sparkSession, name)
        df = _staged(step(df), path)
        if last is not None:
            _delete(df.sparkSession, last)
        last = path
    return df


def ingest_csv(
    spark: SparkSession,
    source_path: str,
    output_path: str,
    schema: StructType | None = None,
    multi_line: bool = True,
) -> int:
    """Copy CSV with a header to Parquet, unchanged, and return the number of rows written.

    Quoted fields may hold line breaks and doubled quotes. A multi-line CSV file cannot be split,
    so large inputs should be a folder of files; with ``multi_line=False`` single files split too.
    Types are inferred in one extra pass over the text unless a schema is given.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, escape='"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    reader.csv(str(source_path)).write.mode("overwrite").parquet(str(output_path))
    # Counting the written Parquet reads only file footers; counting the CSV would parse it again.
    return spark.read.parquet(str(output_path)).count()


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table at *path* and return it as read back. *df* must not read from *path*."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(str(path))
    return read_table(df.sparkSession, df.schema, path)


def read_table(spark: SparkSession, schema: StructType, *paths: str) -> DataFrame:
    """A Parquet table of known schema, with its columns in declared order."""
    # Partition columns would otherwise come last.
    return spark.read.schema(schema).parquet(*map(str, paths)).select(schema.names)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to the table at *path*, creating it when absent."""
    df.write.mode("append").partitionBy(*partition_by).parquet(str(path))


def read_table_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at *path*, or an empty one when the path does not exist. Other errors are raised."""
    try:
        return read_table(spark, schema, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
