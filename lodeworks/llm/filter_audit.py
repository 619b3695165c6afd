"""Audit of how document filters interact: what each removes, in every order, over a sparse document-term matrix.

Method. Documents are gathered into shards of a bounded size. A shard encodes its words by a dictionary of its own and
holds its counts as compressed sparse rows. The words of all shards' dictionaries are dealt out by hash and numbered
once, so that the whole corpus shares one dense dictionary, and the numbers replace the shards' own. Row sums of the
matrix are the words of a document, its stored entries the distinct ones; both decide the filters A and B. The flags
of C, D and E are attached, and documents are counted by the set of filters that they fail. All orders of the filters
follow from these counts, without another look at the documents.

A: under 100 words. B: distinct words under 80 percent of the words. C: over 10 percent capitals A-Z. D: holds one of
#$%&*|. E: the text of a smaller doc_id. Words are maximal runs without ASCII white space, case-sensitive.

Scale. Texts are read once and never shuffled. What is shuffled: each word once a shard, in lists by bucket, the shards'
numeric rows, and narrow rows of flags. A word that all documents hold is one entry a shard. Copies meet by digest, in a
grouped minimum combined before its shuffle and in a join of written tables, which adaptive execution splits. A shard
is a row group of its own, and Arrow batches are bounded by bytes, so a task holds few shards at once, however many
it has. One number a bucket of words and one row a part, with at most 128 counts, are all that is gathered.

Defined results. A null text is the empty one, with no words; a null lang is the empty text. Texts are equal if their
128-bit digests are. A null doc_id is no copy, and nothing is a copy of it; rows that share doc_id and text are not
copies of each other, but each is counted. Labels of one doc_id count if any of its rows says 1. Documents without
label are lost neither as good nor as toxic. An empty table gives no rows. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from lodeworks.llm.common import light_batches, small_batches, stage

FILTERS = "ABCDE"
SHARD_BYTES = 4 << 20  # of text, about; longer texts are shards of their own
BUCKET_WORDS = 500_000  # shard words that one task numbers, about
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that start no code point
_MARKS = b"#$%&*|"
_MEASURES = [("points", pa.int64()), ("capitals", pa.int64()), ("marked", pa.bool_()), ("digest", pa.binary())]
_MEASURED = "points long, capitals long, marked boolean, digest binary"
_PIECES = pa.schema(
    [("bucket", pa.int32()), ("shard", pa.int64()), ("own", pa.list_(pa.int32())), ("words", pa.list_(pa.string()))]
)
_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def _one_row(values: pa.Array | pa.ChunkedArray) -> pa.Array:
    flat = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def sparse_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The words of texts: starts of the rows, terms and counts of their entries, and the words that terms stand for."""
    words = pc.ascii_split_whitespace(texts)
    coded = words.flatten().dictionary_encode()
    rows = np.repeat(np.arange(len(texts)), words.value_lengths().to_numpy())
    terms, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    empty = pc.index(known, "").as_py()  # white space at an end of a text makes an empty word
    if empty >= 0:
        real = terms != empty
        rows, terms = rows[real], terms[real]
        terms -= terms > empty
        known = known.filter(pc.not_equal(known, ""))
    entries = rows * len(known) + terms
    entries.sort()
    first = np.flatnonzero(np.concatenate([[True] * (len(entries) > 0), entries[1:] != entries[:-1]]))
    counts = np.diff(np.concatenate([first, [len(entries)]])).astype(np.int32)
    starts = np.searchsorted(entries[first], np.arange(len(texts) + 1) * len(known))
    return starts, (entries[first] % max(len(known), 1)).astype(np.int32), counts, known


def _measures(text: bytes) -> tuple[int, int, bool, bytes]:
    return (
        len(text.translate(None, _FOLLOWING)),
        len(text) - len(text.translate(None, _CAPITALS)),
        len(text.translate(None, _MARKS)) < len(text),
        hashlib.blake2b(text, digest_size=16).digest(),
    )


def _local_shards(names: list[str]):
    """Shards of the documents of a task: kept columns and measures as lists, sparse rows, dictionary."""

    def shard(number: int, rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = rows.column("text")
        measures = zip(*map(_measures, texts.cast(pa.binary()).to_pylist()), strict=True)
        starts, terms, counts, words = sparse_rows(texts)
        columns = [pa.array([number], pa.int64()), *(_one_row(rows.column(name)) for name in names)]
        columns += [_one_row(pa.array(values, kind)) for values, (_, kind) in zip(measures, _MEASURES, strict=True)]
        columns += [_one_row(x if isinstance(x, pa.Array) else pa.array(x)) for x in (starts, terms, counts, words)]
        labels = ["shard", *names, *(m for m, _ in _MEASURES), "starts", "terms", "counts", "words"]
        return pa.RecordBatch.from_arrays(columns, labels)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 33)
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.column("text").nbytes
            if size < SHARD_BYTES:
                continue
            rows = pa.concat_batches(held)
            sizes = np.cumsum(pc.binary_length(rows.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = np.flatnonzero(np.diff(sizes // SHARD_BYTES)) + 1
            for start, end in itertools.pairwise([0, *cuts.tolist()]):
                yield shard(next(number), rows.slice(start, end - start))
            held = [rows.slice(cuts[-1] if len(cuts) else 0)]
            size = held[0].column("text").nbytes
        if held and sum(map(len, held)):
            yield shard(next(number), pa.concat_batches(held))

    return shards


def _buckets(words: pa.Array, buckets: int) -> np.ndarray:
    """A bucket for each word, the same wherever the word comes from."""
    _, offsets, data = words.buffers()
    starts = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]]
    starts = starts - starts[0]
    place = np.arange(len(data), dtype=np.int32) - np.repeat(starts[:-1], np.diff(starts))
    factors = np.random.default_rng(0).integers(1, 1 << 62, 64, dtype=np.uint64)
    value = np.add.reduceat((data + np.uint64(1)) * factors[place & 63], starts[:-1])
    return ((value ^ (value >> np.uint64(31))) % np.uint64(buckets)).astype(np.int32)


def _by_bucket(buckets: int):
    """The dictionary of each shard in pieces, by a hash of the word."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, words in zip(batch.column("shard").to_pylist(), batch.column("words"), strict=True):
                if not len(words.values):
                    continue
                bucket = _buckets(words.values, buckets)
                order = np.argsort(bucket, kind="stable").astype(np.int32)
                found, lengths = np.unique(bucket, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found),
                        pa.array(np.full(len(found), shard, np.int64)),
                        _lists(lengths, pa.array(order)),
                        _lists(lengths, words.values.take(pa.array(order))),
                    ],
                    ["bucket", "shard", "own", "words"],
                )

    return pieces


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the words of a bucket from 0; a last row, without shard, has them in that order."""
    rows = pa.Table.from_batches(list(batches), _PIECES).combine_chunks()
    if not len(rows):
        return
    part = TaskContext.get().partitionId()
    words = rows.column("words").combine_chunks()
    coded = words.flatten().dictionary_encode()
    slots = _lists(words.value_lengths().to_numpy(), coded.indices)
    own = rows.column("own").combine_chunks()
    names = ["part", "shard", "own", "slots", "known"]
    numbers = pa.array(np.full(len(rows), part, np.int32))
    yield pa.RecordBatch.from_arrays(
        [numbers, rows.column("shard").combine_chunks(), own, slots, pa.nulls(len(rows), pa.list_(pa.string()))], names
    )
    yield pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, own.type), pa.nulls(1, slots.type), _one_row(coded.dictionary)],
        names,
    )


def _remapped(bases: dict[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards with the numbers of the whole dictionary in place of their own, one at a time."""
    for batch in batches:
        for row in (batch.slice(at, 1) for at in range(len(batch))):
            pieces = row.column("pieces").flatten()
            part, own, slots = (pieces.field(name) for name in ("part", "own", "slots"))
            base = np.array([bases[p] for p in part.to_pylist()], np.int64)
            places = own.flatten().to_numpy()
            numbers = np.zeros(len(places), np.int64)
            numbers[places] = slots.flatten().to_numpy() + np.repeat(base, own.value_lengths().to_numpy())
            terms = numbers[row.column("terms").flatten().to_numpy()]
            columns = [row.column("shard"), row.column("starts"), _one_row(pa.array(terms)), row.column("counts")]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "starts", "terms", "counts"])


def term_matrix(docs: DataFrame, keep: dict[str, Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The document-term matrix of the column ``text``: its dictionary, its shards, and what is known of its rows.

    The dictionary has term (dense from 0) and word. Shards have compressed sparse rows: row r holds the terms and
    counts from starts[r] up to starts[r + 1]. The third table has, by shard, lists over the rows: the columns *keep*,
    and of the texts code points, capitals, whether a mark is found, and a digest.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    wanted = docs.select(text, *(column.alias(name) for name, column in keep.items()))
    names = list(keep)
    measured = StructType.fromDDL(_MEASURED)
    schema = StructType(
        StructType.fromDDL("shard long").fields
        + [StructField(f.name, ArrayType(f.dataType)) for f in [*wanted.schema.fields[1:], *measured.fields]]
        + StructType.fromDDL("starts array<long>, terms array<int>, counts array<int>, words array<string>").fields
    )
    local = stage(light_batches(small_batches(wanted)).mapInArrow(_local_shards(names), schema), "shards", group_rows=1)

    total = local.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    buckets = -(-total // BUCKET_WORDS) or 1
    pieces = local.select("shard", "words").mapInArrow(
        _by_bucket(buckets), "bucket int, shard long, own array<int>, words array<string>"
    )
    coded = stage(
        pieces.repartitionById(buckets, "bucket").mapInArrow(
            _numbered, "part int, shard long, own array<int>, slots array<int>, known array<string>"
        ),
        "terms",
    )
    known = coded.where("shard IS NULL")
    sizes = sorted((r["part"], r["n"]) for r in known.select("part", F.size("known").alias("n")).collect())  # a row a bucket
    bases = dict(zip((p for p, _ in sizes), itertools.accumulate((n for _, n in sizes), initial=0), strict=False))

    base = spark.createDataFrame(list(bases.items()), "part int, base long")
    dictionary = (
        known.join(base, "part")
        .select("base", F.posexplode("known").alias("at", "word"))
        .select((F.col("base") + F.col("at")).alias("term"), "word")
    )
    by_shard = (
        coded.where("shard IS NOT NULL").groupBy("shard").agg(F.collect_list(F.struct("part", "own", "slots")).alias("pieces"))
    )
    numeric = local.select("shard", "starts", "terms", "counts").join(by_shard, "shard", "left")
    shards = numeric.withColumn("pieces", F.coalesce("pieces", F.array())).mapInArrow(
        partial(_remapped, bases), "shard long, starts array<long>, terms array<long>, counts array<int>"
    )
    return dictionary, shards, local.drop("starts", "terms", "counts", "words")


def _row_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard, the sum and the number of stored entries of each row."""
    for batch in batches:
        for row in (batch.slice(at, 1) for at in range(len(batch))):
            starts = row.column("starts").flatten().to_numpy()
            upto = np.concatenate([[0], np.cumsum(row.column("counts").flatten().to_numpy(), dtype=np.int64)])
            sums = (upto[starts[1:]] - upto[starts[:-1]], np.diff(starts))
            columns = [row.column("shard"), *(_one_row(pa.array(x)) for x in sums)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "n_words", "n_distinct"])


def failures(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, part, and the filters that it fails as booleans A to E."""
    keep = {"doc_id": F.col("doc_id"), "part": F.coalesce(F.col("lang"), F.lit(""))}
    _, shards, rows = term_matrix(docs, keep)
    sums = stage(shards.mapInArrow(_row_sums, "shard long, n_words array<long>, n_distinct array<long>"), "row-sums")
    names = ["doc_id", "part", *(name for name, _ in _MEASURES), "n_words", "n_distinct"]
    each = rows.join(sums, "shard").select(F.explode(F.arrays_zip(*names)).alias("row")).select("row.*")
    flags = stage(
        each.select(
            "doc_id",
            "part",
            "digest",
            (F.col("n_words") < 100).alias("A"),
            (100 * F.col("n_distinct") < 80 * F.col("n_words")).alias("B"),
            (100 * F.col("capitals") > 10 * F.col("points")).alias("C"),
            F.col("marked").alias("D"),
        ),
        "flags",
    )
    copies = flags.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1")
    copies = stage(copies.select("digest", "first"), "copies")
    return flags.join(copies, "digest", "left").select(
        "doc_id", "part", *"ABCD", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E")
    )


def _all_orders(part: pd.DataFrame) -> pd.DataFrame:
    """The rows of a part: each order of the filters, step by step, from counts by set of failed filters."""
    name = part["part"].iloc[0]
    totals = np.zeros((3, 1 << len(FILTERS)), np.int64)
    for row, weight in enumerate((np.ones(len(part), np.int64), part["good"].to_numpy(), part["toxic"].to_numpy())):
        np.add.at(totals[row], part["fails"].to_numpy(), part["n"].to_numpy() * weight)
    sets = np.arange(1 << len(FILTERS))
    rows = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << letter
            gone, fails = sets & before > 0, sets & own > 0
            here, removed = totals[:, ~gone & fails].sum(axis=1), totals[0, gone & fails].sum()
            kept = totals[0, ~gone & ~fails].sum()
            text = "".join(FILTERS[f] for f in order)
            rows.append((name, text, step, kept, here[0], removed, totals[0, own], here[1], here[2]))
            before |= own
    found = pd.DataFrame(rows, columns=["part", "filter_order", "step", *_COUNTS])
    letters = [order[step - 1] for order, step in zip(found["filter_order"], found["step"], strict=True)]
    return found.assign(shapley=found.groupby(letters)["removed"].transform("sum"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (value of lang), order of the filters and step, with its counts."""
    marks = stage(
        labels.groupBy(F.col("doc_id").alias("label_id")).agg(
            F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
        ),
        "marks",
    )
    fails = sum((F.col(name).cast("int") * (1 << at) for at, name in enumerate(FILTERS)), F.lit(0))
    found = failures(docs)
    counted = (
        found.join(marks, found["doc_id"] == marks["label_id"], "left")
        .groupBy(
            "part",
            fails.alias("fails"),
            *(F.coalesce(name, F.lit(False)).cast("int").alias(name) for name in ("good", "toxic")),
        )
        .agg(F.count("*").alias("n"))
    )
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in [*_COUNTS, "shapley"])
    return counted.groupBy("part").applyInPandas(_all_orders, schema)
