"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.sources.tables import stage

ROWS_PER_PART = 5_000_000  # target size of a partition of numbered rows
LEAST_ROWS = 50_000  # fewer rows are not spread over more partitions, each of which is a file later

_SLOT_BITS = 33  # monotonically_increasing_id holds the position in its lower 33 bits
_CELL_BITS = 10
CELLS = 1 << _CELL_BITS


def assign_keys(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    start: int = 0,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Number the rows ``start + 1, start + 2, …`` in the given order; keep only *columns* if given.

    Equal to a global ``row_number``, without its single partition: rows are range-partitioned and
    sorted, and then numbered by partition and position. Ranges are taken over the whole order, so
    one dominant leading value is split.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return _number(placed, key, start, columns or df.columns)


def hash_cell(row_hash: Column) -> Column:
    """One of CELLS cells of 64-bit hashes, in the order of the hashes."""
    return F.shiftright(row_hash, 64 - _CELL_BITS) + F.lit(CELLS // 2)


def count_cells(df: DataFrame, batch: str, row_hash: Column) -> dict[tuple[int, int], int]:
    """Rows per batch and cell of the row hash: the histogram for assign_batch_keys.

    At most CELLS small rows per batch reach the driver.
    """
    cells = df.groupBy(batch, hash_cell(row_hash).alias("_cell")).count()
    return {(row[batch], row["_cell"]): row["count"] for row in cells.collect()}


def assign_batch_keys(
    df: DataFrame,
    key: str,
    batch: str,
    counts: Mapping[tuple[int, int], int],
    row_hash: Column,
    start: int = 0,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Number the rows batch by batch, and within a batch by a 64-bit hash of the row.

    For tables whose order within a batch has no meaning: the numbering is reproducible if the hash
    covers all that tells rows apart. *counts* is the histogram of count_cells() over the
    same rows, taken before they were joined with anything. Its prefix sums give every cell its first
    key beforehand, so the rows are placed and numbered in one shuffle, and nothing is staged. Cells
    are dealt to partitions in order, by their share of the rows.
    """
    sizes: dict[int, int] = {}
    for (number, _), count in counts.items():
        sizes[number] = sizes.get(number, 0) + count
    total = sum(sizes.values())
    spread = -(-total // df.sparkSession.sparkContext.defaultParallelism)
    per_part = min(ROWS_PER_PART, max(LEAST_ROWS, spread))
    numbers = sorted(sizes)
    before = dict(zip(numbers, accumulate((sizes[number] for number in numbers), initial=0)))
    parts = max(1, -(-total // per_part))

    def part_of(number: int, cell: int) -> int:
        return (before[number] * CELLS + cell * sizes[number]) // (per_part * CELLS)

    filled = [0] * parts
    for (number, cell), count in counts.items():
        filled[part_of(number, cell)] += count
    slots = range(max(numbers, default=0) + 1)
    first_row = F.get(_listed([before.get(slot, 0) for slot in slots]), F.col(batch).cast("int"))
    rows = F.get(_listed([sizes.get(slot, 0) for slot in slots]), F.col(batch).cast("int"))
    rank = first_row * F.lit(CELLS) + hash_cell(F.col("_hash")) * rows
    whole = F.lit(per_part * CELLS)
    # Rows of batches that were not counted go to the last partition, where they fail.
    part = F.coalesce(((rank - rank % whole) / whole).cast("int"), F.lit(parts - 1))
    placed = (
        df.withColumn("_hash", row_hash)
        .select(*dict.fromkeys([*(columns or df.columns), batch, "_hash"]), part.alias("_target"))
        .repartitionById(parts, "_target")
        .sortWithinPartitions(batch, "_hash")
    )
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    counted = placed.withColumn("_slot", position)
    # More rows than were counted would get the keys of the next partition.
    slot = F.when(F.col("_slot") < _listed(filled)[F.col("_target")], F.col("_slot")).otherwise(
        F.raise_error(F.lit(f"{key}: rows were not counted beforehand")).cast("bigint")
    )
    offsets = _listed(list(accumulate(filled, initial=start)))
    return counted.select((offsets[F.col("_target")] + slot + 1).alias(key), *(columns or df.columns))


def _listed(values: Sequence[int]) -> Column:
    """The values as one constant array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _number(placed: DataFrame, key: str, start: int, columns: Sequence[str]) -> DataFrame:
    """Number sorted partitions one after another.

    Rows are written with their partition and position, and each partition then adds the number of
    rows before it. Only the row count per partition reaches the driver.
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    written = stage(
        placed.select(*columns, F.spark_partition_id().alias("_part"), position.alias("_slot")), key
    )
    sizes = {row["_part"]: row["count"] for row in written.groupBy("_part").count().collect()}
    counts = [sizes.get(part, 0) for part in range(max(sizes, default=-1) + 1)]
    offsets = _listed(list(accumulate(counts, initial=start)))
    return written.select((offsets[F.col("_part")] + F.col("_slot") + 1).alias(key), *columns)


def max_key(df: DataFrame | None, key: str) -> int:
    """The largest key in use, 0 for an empty or absent table."""
    if df is None:
        return 0
    return df.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).first()["top"]
