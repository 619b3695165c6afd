"""Removal of repeated byte strings by a distributed suffix order over a sample of the suffixes that texts choose themselves.

Method. Every string of *length* bytes contains a seed, the first of its pieces of 16 bytes with the least hash; equal
strings have equal seeds at equal distances. A place is a seed in a text, together with the range of strings that have
it, some 43 bytes apart. A place whose seed occurs at one place only belongs to strings that occur once. Of the others, ranges
with the same bytes are represented by the earliest one, as the strings of the later ones all start earlier there.

If places of different bytes share a seed, two orders are made of them: of the suffixes that begin at their seeds, and of
the prefixes that end there, read backwards. Neighbours are compared, which gives the branches of the two suffix trees:
the places that agree in so many bytes, from the first to the last of a run in the order. Two strings are equal if and
only if their seeds are equally far from their starts and their places share a branch in both orders there. A pair of
branches holds for a range of strings, the same one at each of its places, so one row a pair and place decides. All but
the earliest mark their bytes.

Scale. Rows are places, not bytes; text goes with those only whose seeds have different surroundings. All orders are range
partitions, a partition of which fits into a task's memory, as their number follows the rows. Equal keys may spread over
partitions (the row number breaks ties), so a passage that a third of all documents share is no hot task; a partition tells
the driver its first and last text and their runs, one row each. Only when the marks of a text return to it, they meet in one
task. Shuffle files of a step are removed once its rows are written.

Defined results. A null text is empty. Rows that share doc_id and text are one document and are treated alike. Rows that
share only doc_id come in the order of their texts' SHA-256. A null doc_id comes first. Texts shorter than *length*
stay. An empty table gives no rows. Other columns are not handed on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodeworks.llm.common import stage

SEED = 16  # bytes
_BLOCK = 20  # bits of a position within a block
_ORDERED = 30_000  # rows of a partition of an order
_DOC = ["doc_id", "digest"]
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, name: str) -> DataFrame:
    """`stage`, after which the shuffle files of the step are removed; together they would take several times the input."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return stage(df, name)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)


def _schema(df: DataFrame, more: str) -> StructType:
    """The columns that name a document, as they are in *df*, and *more*."""
    return StructType([df.schema[c] for c in _DOC] + StructType.fromDDL(more).fields)


# --- what can repeat -----------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each piece of *size* bytes, 16 at most, from the words that it begins and ends with."""
    n, word = len(data) - size + 1, min(size, 8)
    words = np.zeros(len(data) - word + 1, np.uint64)
    for k in range(word):
        words |= data[k : k + len(words)].astype(np.uint64) << np.uint64(8 * k)
    return _mixed(_mixed(words[:n]) + words[size - word : size - word + n])


def seeds(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The seeds of a text: hash, place, and first and last start of the strings of *length* bytes that have them."""
    size = min(SEED, length)
    value = _hashes(data, size)
    width, low = length - size + 1, np.uint64((1 << _BLOCK) - 1)
    step = (1 << _BLOCK) - width
    places = []
    for block in range(0, len(value) - width + 1, step):
        # Positions in the lowest bits make the least value that of the first piece with the least hash.
        least = value[block : block + step + width - 1]
        least = (least & ~low) | np.arange(len(least), dtype=np.uint64)
        covered = 1
        while covered < width:
            more = min(covered, width - covered)
            least = np.minimum(least[:-more], least[more:])
            covered += more
        places.append((least & low).astype(np.int64) + block)
    place = np.concatenate(places)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return value[place[first]].view(np.int64), place[first], first, np.concatenate([first[1:], [len(place)]]) - 1


def _bodies(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, bytes]]:
    for row, body in enumerate(batch.column("body")):
        if len(body := body.as_py()) >= length:
            yield row, body


def _seed_rows(length: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [seeds(np.frombuffer(body, np.uint8), length)[0] for _, body in _bodies(batch, length)]
        if found:
            yield pa.record_batch({"seed": np.concatenate(found)})


def _place_rows(length: int, batches: Iterable[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Seed, digest of the range and of where its seed lies, and the range: first start, starts after it, seed's distance."""

    def frame(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
        row, seed, own, at = (np.concatenate(x) for x in zip(*held, strict=True))
        names = {c: batch.column(c).take(pa.array(row)) for c in _DOC}
        return pa.record_batch(names | {"seed": seed, "own": own.view(np.int64), "at": at})

    for batch in batches:
        held, size = [], 0
        for row, body in _bodies(batch, length):
            seed, place, first, last = seeds(np.frombuffer(body, np.uint8), length)
            within = (last - first) * length + place - first
            ranges = zip(first.tolist(), (last + length).tolist(), within.tolist(), strict=True)
            own = np.array([xxhash.xxh3_64_intdigest(body[a:b], w) for a, b, w in ranges], np.uint64)
            held.append((np.full(len(seed), row), seed, own, first * length**2 + within))
            size += len(seed)
            if size >= rows:
                yield frame(batch, held)
                held, size = [], 0
        if held:
            yield frame(batch, held)


def _first(length: int) -> Column:
    return F.expr(f"at div {length**2}")


def _more(length: int) -> Column:
    return F.expr(f"at % {length**2} div {length}")


def _distance(length: int) -> Column:
    return F.col("at") % length


def candidates(texts: DataFrame, length: int) -> DataFrame:
    """The places (doc_id, digest, seed, own, at) of texts (doc_id, digest, body) outside of which no string of *length* bytes repeats.

    A seed that a text has more than once counts, as do rows that are one document.
    """
    texts = texts.where(F.octet_length("body") >= length)
    found = texts.mapInArrow(partial(_place_rows, length), _schema(texts, "seed long, own long, at long"))
    repeated = texts.select("body").mapInArrow(partial(_seed_rows, length), "seed long")
    repeated = repeated.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed")
    return found.join(_written(repeated, "repeated-seeds"), "seed").select(*_DOC, "seed", "own", "at")


# --- orders --------------------------------------------------------------------------------------


def _agreeing(texts: pa.Array, deepest: int) -> tuple[np.ndarray, np.ndarray]:
    """In how many bytes each text agrees with the one before it; and the lengths of texts."""
    data = [np.frombuffer(x.as_py(), np.uint8) for x in texts]
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    there = np.arange(deepest) < lengths[:, None]
    whole = np.zeros(there.shape, np.uint8)
    whole[there] = np.concatenate(data)
    apart = np.ones((len(data) - 1, deepest + 1), bool)
    apart[:, :-1] = (whole[1:] != whole[:-1]) | ~there[1:] | ~there[:-1]
    return apart.argmax(axis=1), lengths


def _runs(deepest: int, single: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row of a sorted partition and each depth from lo to hi the run of rows that agree so far, where it changes.

    Runs of a single row are left out, unless asked for. The last row yielded describes the partition: rows, the run of its last row that begins
    and that of its first row that ends at each depth, and the first and last text.
    """
    batches = [batch for batch in batches if batch.num_rows]
    if not batches:
        return
    part = TaskContext.get().partitionId()
    table = pa.Table.from_batches(batches).combine_chunks()
    n, texts = table.num_rows, table.column("text")
    near, _ = _agreeing(texts, deepest)
    depths = np.arange(deepest + 1)
    apart = near[:, None] < depths  # whether a row begins a run at a depth; that of the first row is the driver's to find
    row = np.arange(n, dtype=np.int32)[:, None]
    begin = np.zeros((n, deepest + 1), np.int32)
    begin[1:] = np.where(apart, row[1:], 0)
    np.maximum.accumulate(begin, axis=0, out=begin)
    end = np.full((n, deepest + 1), n - 1, np.int32)
    end[:-1] = np.where(apart, row[:-1], n - 1)
    end = np.minimum.accumulate(end[::-1], axis=0)[::-1]
    lo, hi = (table.column(c).to_numpy()[:, None] for c in ("lo", "hi"))
    asked = (depths >= lo) & (depths <= hi)
    asked &= single | (begin < end) | (begin == 0) | (end == n - 1)
    new = asked.copy()
    new[:, 1:] &= ~asked[:, :-1] | (begin[:, 1:] != begin[:, :-1]) | (end[:, 1:] != end[:, :-1])
    last = asked.copy()
    last[:, :-1] &= ~asked[:, 1:] | new[:, 1:]
    which, lowest = np.nonzero(new)
    ids = table.column("id").to_numpy()
    yield pa.record_batch({
        "id": ids[which], "part": np.full(len(which), part, np.int32), "lo": lowest.astype(np.int32),
        "hi": np.nonzero(last)[1].astype(np.int32), "begin": begin[which, lowest].astype(np.int64),
        "end": end[which, lowest].astype(np.int64), "stat": pa.nulls(len(which), pa.list_(pa.int64())),
        "texts": pa.nulls(len(which), pa.list_(pa.binary())),
    })
    one = {c: np.zeros(1, kind) for c, kind in (("lo", np.int32), ("hi", np.int32), ("begin", np.int64), ("end", np.int64))}
    yield pa.record_batch({"id": np.array([-1]), "part": np.array([part], np.int32)} | one | {
        "stat": pa.array([np.concatenate([[n], begin[-1], end[0]])], pa.list_(pa.int64())),
        "texts": pa.array([[texts[0].as_py(), texts[n - 1].as_py()]], pa.list_(pa.binary())),
    })


def _across(stats: list, deepest: int) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per partition: rows, and at each depth the number of the first and last row of runs that reach its ends."""
    depths, known = np.arange(deepest + 1), []
    for part, stat, (first, last) in sorted(stats):
        stat = np.asarray(stat)
        known.append((part, stat[0], stat[1 : deepest + 2], stat[deepest + 2 :], first, last))
    joined = [_agreeing(pa.array([a[5], b[4]]), deepest)[0][0] for a, b in zip(known, known[1:], strict=False)]
    leads, trails = [], []
    for k, (part, _, begin, *_) in enumerate(known):
        own = np.full(deepest + 1, part << 32)
        leads.append(np.where(depths <= joined[k - 1], before, own) if k else own)
        before = np.where(begin > 0, (part << 32) + begin, leads[-1])
    for k, (part, n, _, end, *_) in reversed(list(enumerate(known))):
        own = np.full(deepest + 1, (part << 32) + n - 1)
        trails.append(np.where(depths <= joined[k], after, own) if k + 1 < len(known) else own)
        after = np.where(end < n - 1, (part << 32) + end, trails[-1])
    return {x[0]: (x[1], lead, trail) for x, lead, trail in zip(known, leads, trails[::-1], strict=True)}


def _numbered(across: dict, single: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs with the numbers of their first and last rows; those that reach the ends of a partition are cut where these change."""
    for batch in batches:
        columns = {c: batch.column(c).to_numpy() for c in ("id", "part", "lo", "hi", "begin", "end")}
        parts = columns["part"]
        for part in np.unique(parts).tolist():
            n, lead, trail = across[part]
            rows = {c: x[parts == part] for c, x in columns.items()}
            wide = np.where((rows["begin"] == 0) | (rows["end"] == n - 1), rows["hi"] - rows["lo"] + 1, 1)
            row = np.repeat(np.arange(len(wide)), wide)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(wide) - wide, wide)
            depth = rows["lo"][row] + nth
            begin, end = rows["begin"][row], rows["end"][row]
            begin = np.where(begin == 0, lead[depth], (part << 32) + begin)
            end = np.where(end == n - 1, trail[depth], (part << 32) + end)
            new = nth == 0
            new[1:] |= (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
            at = np.flatnonzero(new)
            last = np.concatenate([at[1:], [len(row)]]) - 1
            hi = np.where(nth[last] + 1 == wide[row[last]], rows["hi"][row[last]], depth[last])
            kept = single | (begin[at] < end[at])
            out = {"id": rows["id"][row[at]], "lo": depth[at].astype(np.int32), "hi": hi.astype(np.int32)}
            yield pa.record_batch({c: x[kept] for c, x in (out | {"begin": begin[at], "end": end[at]}).items()})


def branches(rows: DataFrame, deepest: int, single: bool = False) -> DataFrame:
    """The branches of the suffix tree of *rows* (id, text, lo, hi) at the depths lo to hi, which no text is shorter than.

    A branch is the run of rows, in the order of their texts, that agree in so many bytes: per row and branch the depths from lo to hi at
    which the row is in it, and the numbers of the run's first and last rows, which rise in the order of texts. Runs of a
    *single* row are left out, unless asked for.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // _ORDERED + 1)
    placed = rows.select("id", "text", "lo", "hi").repartitionByRange(parts, "text", "id").sortWithinPartitions("text", "id")
    schema = "id long, part int, lo int, hi int, begin long, end long, stat array<long>, texts array<binary>"
    keep = partial(_runs, deepest, single)
    written = _written(placed.mapInArrow(keep, schema), "runs")
    stats = written.where("stat IS NOT NULL").select("part", "stat", "texts").collect()  # one row a partition
    across = _across([(r["part"], r["stat"], [bytes(x) for x in r["texts"]]) for r in stats], deepest)
    runs = written.where("stat IS NULL").drop("stat", "texts")
    return runs.mapInArrow(partial(_numbered, across, single), "id long, lo int, hi int, begin long, end long")


def ranks(stretches: DataFrame, length: int) -> DataFrame:
    """The rank of each suffix of the stretches (doc, at, body) among all, in the order of *length* bytes; ranks leave gaps."""

    @F.udf("array<binary>")
    def suffixes(body: bytes) -> list[bytes]:
        return [bytes(body[k : k + length]) for k in range(len(body))]

    whole = stretches.select("doc", "at", F.posexplode(suffixes("body")).alias("pos", "text"))
    whole = _written(whole.withColumn("id", F.monotonically_increasing_id()), "suffixes")
    size = F.octet_length("text")
    found = branches(whole.select("id", "text", size.alias("lo"), size.alias("hi")), length, single=True)
    placed = whole.drop("text").join(found, "id").groupBy("doc", "at").agg(F.sort_array(F.collect_list(F.struct("pos", "begin"))).alias("v"))
    return placed.select("doc", "at", F.col("v.begin").alias("v"))


# --- marks ---------------------------------------------------------------------------------------


def _surroundings(length: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For places of a text the bytes of their ranges from the seed on, and those before it backwards."""
    for batch in batches:
        row, places, before, after = [], [], [], []
        for nth, (body, ats) in enumerate(zip(batch.column("body"), batch.column("ats"), strict=True)):
            body = body.as_py()
            for at in ats.as_py():
                first, within = divmod(at, length**2)
                more, distance = divmod(within, length)
                row.append(nth)
                places.append(at)
                before.append(body[first : first + distance][::-1])
                after.append(body[first + distance : first + more + length])
        names = {c: batch.column(c).take(pa.array(row, pa.int32())) for c in _DOC}
        texts = {"before": pa.array(before, pa.binary()), "after": pa.array(after, pa.binary())}
        yield pa.record_batch(names | {"at": pa.array(places, pa.int64())} | texts)


def repeats(texts: DataFrame, length: int) -> DataFrame:
    """Per document, the stretches of its body in which strings of *length* bytes also start earlier: doc, starts, stops."""
    doc, place = F.struct(*_DOC).alias("doc"), F.struct(*_DOC, "at")
    places = _written(candidates(texts, length), "places")
    ranges = _written(places.groupBy("seed", "own").agg(F.min(place).alias("first")), "ranges")
    first = _first(length)
    copies = places.join(ranges, ["seed", "own"]).where(~place.eqNullSafe(F.col("first")))
    copies = copies.select(*_DOC, first.alias("start"), (first + _more(length) + length).alias("stop"))

    several = ranges.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed")
    wanted = ranges.join(several, "seed").select("first.*")
    wanted = wanted.groupBy(doc).agg(F.collect_list("at").alias("ats"))
    around = texts.select("body", doc).join(wanted, "doc").select("doc.*", "body", "ats")
    around = around.mapInArrow(partial(_surroundings, length), _schema(texts, "at long, before binary, after binary"))
    around = _written(around.withColumn("id", F.monotonically_increasing_id()), "surroundings")

    # In either order the depths at which strings agree, as distances of the seed from the start of the string.
    distance, more = _distance(length), _more(length)
    rows = around.select("id", F.col("after").alias("text"), (length - distance).alias("lo"), (length - distance + more).alias("hi"))
    after = branches(rows.select("id", "text", F.col("lo").cast("int"), F.col("hi").cast("int")), length)
    after = after.select("id", (length - F.col("hi")).alias("lo1"), (length - F.col("lo")).alias("hi1"), F.col("begin").alias("b1"), F.col("end").alias("e1"))
    rows = around.select("id", F.col("before").alias("text"), (distance - more).alias("lo"), distance.alias("hi"))
    before = branches(rows.select("id", "text", F.col("lo").cast("int"), F.col("hi").cast("int")), length)
    before = before.select("id", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("begin").alias("b2"), F.col("end").alias("e2"))
    least, most = F.greatest("lo1", "lo2").alias("least"), F.least("hi1", "hi2").alias("most")
    pairs = after.join(before, "id").join(around.select("id", *_DOC, "at"), "id").where(least <= most)
    pairs = _written(pairs.select(*_DOC, "at", least, most, "b1", "e1", "b2", "e2"), "pairs")

    both = ["b1", "e1", "b2", "e2"]
    earliest = pairs.groupBy(both).agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    earliest = _written(earliest, "earliest")  # read again, so that a large group of the join can be split
    later = pairs.join(earliest, both).where(~place.eqNullSafe(F.col("first")))
    seed = first + distance
    later = later.select(*_DOC, (seed - F.col("most")).alias("start"), (seed - F.col("least") + length).alias("stop"))
    marks = _written(copies.unionByName(later), "marks")
    return marks.groupBy(doc).agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))


def _cut(bodies: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.DataFrame:
    out = []
    for body, first, last in zip(bodies, starts, stops, strict=True):
        change = np.zeros(len(body) + 1, np.int64)
        if first is not None:
            np.add.at(change, np.asarray(first), 1)
            np.add.at(change, np.asarray(last), -1)
        gone = np.cumsum(change[:-1]) > 0
        spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])))
        out.append((np.frombuffer(body, np.uint8)[~gone].tobytes(), int(gone.sum()), spans))
    return pd.DataFrame(out, columns=["rest", "n_removed", "n_spans"])


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """Per row of *docs*: doc_id, n_bytes, n_removed, n_spans, and the bytes that remain as ``rest``."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    texts = texts.withColumn("digest", F.conv(F.substring(F.sha2("body", 256), 1, 15), 16, 10).cast("long"))
    marks = repeats(texts, length)
    joined = texts.select("doc_id", "body", F.struct(*_DOC).alias("doc")).join(marks, "doc", "left")
    size = F.octet_length("body").cast("long").alias("n_bytes")
    cut = F.pandas_udf(_cut, "rest binary, n_removed long, n_spans long")("body", "starts", "stops").alias("cut")
    return joined.select("doc_id", size, cut).select(
        "doc_id", "n_bytes", "cut.n_removed", "cut.n_spans", "cut.rest"
    )
