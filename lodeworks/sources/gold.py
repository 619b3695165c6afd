"""The gold folder: every load writes new folders, and is published by one appended row.

Nothing a reader may be using is ever overwritten, and a load that fails midway is never seen: its
folders are not listed, and the next load replaces them. One loader at a time may write.

Tables that only grow are the rows of all loads. Of the others a load writes what it changes, as a
delta sorted by key; readers take, of the rows that share a key, the one that was written last. A
compaction writes such tables anew as one delta, on which later reads and loads build.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodeworks.schemas import table_schema
from lodeworks.sources.tables import append_rows, read_table_or_empty, write_table

_LOAD = table_schema({"load": "long"}, ())
_LOADS = table_schema(
    {"load_id": "long", "rebuild": "boolean", "last_fact_key": "long", "compacted": "boolean",
     "rebound": "boolean", "arrival": "string"},
    (),
)


@dataclass(frozen=True)
class Merged:
    """A table of deltas: rows of one *key* replace each other."""

    table: str
    schema: StructType
    key: str
    partition_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Loads:
    """The published loads: those whose rows are added up, and those whose deltas are merged.

    *rebound* are those that wrote facts of earlier loads again.
    """

    last: Row | None
    added: tuple[int, ...]
    merged: tuple[int, ...]
    rebound: tuple[int, ...] = ()

    def then(self, load_id: int) -> Loads:
        """These loads, and one that is written and not published yet."""
        return Loads(self.last, (*self.added, load_id), (*self.merged, load_id), self.rebound)


NO_LOADS = Loads(None, (), ())


@dataclass(frozen=True)
class Gold:
    spark: SparkSession
    path: str

    def loads(self) -> Loads:
        """What is published now; a load is one small row."""
        found = read_table_or_empty(self.spark, f"{self.path}/_loads", _LOADS).collect()
        rows = sorted(found, key=lambda load: load["load_id"])
        rebuilt = max((row["load_id"] for row in rows if row["rebuild"]), default=0)
        rows = [row for row in rows if row["load_id"] >= rebuilt]
        base = max((row["load_id"] for row in rows if row["rebuild"] or row["compacted"]), default=0)
        return Loads(
            rows[-1] if rows else None,
            tuple(row["load_id"] for row in rows if not row["compacted"]),
            tuple(row["load_id"] for row in rows if row["load_id"] >= base),
            tuple(row["load_id"] for row in rows if row["rebound"]),
        )

    def has_arrival(self, arrival: str) -> bool:
        """Whether a load was published that came with this arrival."""
        rows = read_table_or_empty(self.spark, f"{self.path}/_loads", _LOADS)
        return not rows.filter(F.col("arrival") == arrival).isEmpty()

    def _folder(self, table: str, load_id: int) -> str:
        return f"{self.path}/{table}/load={load_id}"

    def lineage_path(self) -> str:
        return f"{self.path}/pipeline_lineage"

    def last_load(self) -> Row | None:
        """The newest published load, if any."""
        return self.loads().last

    def write_snapshot(
        self, table: str, df: DataFrame, load_id: int, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write the rows of one load and return them as read back; readers do not see them yet."""
        return write_table(df, self._folder(table, load_id), partition_by)

    def write_delta(self, merged: Merged, df: DataFrame, load_id: int) -> DataFrame:
        """Write what a load changes in a table of deltas, sorted by key."""
        ordered = df.sortWithinPartitions(*merged.partition_by, merged.key)
        return self.write_snapshot(merged.table, ordered, load_id, merged.partition_by)

    def publish(
        self,
        load_id: int,
        rebuild: bool,
        last_fact_key: int,
        compacted: bool = False,
        rebound: bool = False,
        arrival: str | None = None,
    ) -> None:
        """Make a load visible, after all its tables are written."""
        row = (load_id, rebuild, last_fact_key, compacted, rebound, arrival)
        row = self.spark.createDataFrame([row], _LOADS)
        append_rows(row.coalesce(1), f"{self.path}/_loads")

    def _read(self, table: str, schema: StructType, load_ids: Sequence[int]) -> DataFrame:
        """Rows of some loads, with the load as a column (a partition column, for pruning)."""
        if not load_ids:
            return self.spark.createDataFrame([], schema).withColumn("load", F.lit(0))
        reader = self.spark.read.option("basePath", f"{self.path}/{table}")
        folders = [self._folder(table, load_id) for load_id in load_ids]
        return reader.schema(StructType([*schema, *_LOAD])).parquet(*folders)

    def read_latest(self, table: str, schema: StructType) -> DataFrame:
        """A table that every load replaces as a whole."""
        return self._read(table, schema, self.loads().added[-1:]).select(schema.names)

    def read_all(self, table: str, schema: StructType, loads: Loads | None = None) -> DataFrame:
        """A table that every load adds to."""
        ids = (self.loads() if loads is None else loads).added
        return self._read(table, schema, ids).select(schema.names)

    def read_merged(self, merged: Merged, loads: Loads | None = None) -> DataFrame:
        """A table of deltas: of the rows with one key, the one of the newest load.

        Without later deltas the first one is read as it is. Otherwise only the later ones are grouped
        by key; the first, which is the large one, is filtered by their keys, and not shuffled while
        these are few enough to be broadcast.
        """
        ids = (self.loads() if loads is None else loads).merged
        names = merged.schema.names
        base = self._read(merged.table, merged.schema, ids[:1]).select(names)
        if len(ids) < 2:
            return base
        later = self._read(merged.table, merged.schema, ids[1:])
        if len(ids) > 2:
            later = later.groupBy(merged.key).agg(F.max_by(F.struct(*names), "load").alias("_row"))
            later = later.select("_row.*")
        later = later.select(names)
        return base.join(later.select(merged.key), merged.key, "left_anti").select(names).unionByName(later)

    def compact(self, tables: Sequence[Merged]) -> int | None:
        """Write tables of deltas anew, each as one delta, and publish them together.

        What they hold stays the same. Returns the load, or nothing where there is nothing to merge.
        """
        loads = self.loads()
        if len(loads.merged) < 2:
            return None
        load_id = loads.last["load_id"] + 1
        for merged in tables:
            self.write_delta(merged, self.read_merged(merged, loads), load_id)
        self.publish(load_id, False, loads.last["last_fact_key"], True)
        return load_id

    def remove_superseded(
        self, tables: Sequence[str], merged: Sequence[Merged], rebound: Sequence[Merged] = ()
    ) -> list[str]:
        """Delete the folders that no published state needs any more, and return their names.

        These are the loads before the last rebuild; of tables of deltas, which *merged* lists, also those
        before the last compaction; and what failed loads have left. No reader may still use an older state.
        """
        loads = self.loads()
        keep = {table: set(loads.added) for table in tables}
        keep |= {m.table: set(loads.merged) for m in merged} | {m.table: set(loads.rebound) for m in rebound}
        context = self.spark.sparkContext
        removed = []
        for table, ids in keep.items():
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
            files = path.getFileSystem(context._jsc.hadoopConfiguration())
            for status in files.listStatus(path) if files.exists(path) else []:
                name = status.getPath().getName()
                if not name.startswith("load="):
                    continue
                if int(name.removeprefix("load=")) not in ids:
                    files.delete(status.getPath(), True)
                    removed.append(f"{table}/{name}")
        return sorted(removed)
