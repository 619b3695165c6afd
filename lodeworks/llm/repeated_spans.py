"""Removal of text that repeats: spans of several consecutive sentences, compared over all documents.

Method. A text is cut into sentences: up to a stop (. ! ? , ; :) or a line end. A stretch of more than
MOST_WORDS words without a stop is cut before the least word hash of each WINDOW words in a row, so that every
text has short steps, and those of a repeated passage lie alike whatever words come before it: all but its first
and last WINDOW words at most. A span begins at each sentence and takes the fewest sentences,
at least *run*, that hold *least_words* words. Spans are compared by a 64-bit hash of their lower-case
words. The first occurrence of a span, by (doc_id, text, position), stays; sentences covered by any other
occurrence go.

Scale. Short texts are cut and hashed many at a time, all their words at once. A grouped minimum, combined before its shuffle,
finds first occurrences and is written; a join with the repeated hashes alone finds the others. A frequent passage is
one row per task in the first and, as both sides of the join are shuffled for it, a key that is split in the second.

Defined results. Null texts stay null; texts with fewer words or sentences than a span stay as they are.
Rows that share doc_id and text are the same document and are treated alike. A null doc_id comes first.
Other columns are handed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import small_batches, stage

MOST_WORDS = 12
WINDOW = 10  # a shared stretch of 51 words keeps at least 32 between shared cuts, enough for three pieces and 20 words
STOPS = ".!?,;:"
CHUNK = 1 << 16  # characters cut together, so that their arrays stay in the cache; a longer text is cut alone
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_KNOWN = 0x3001  # there is no white space from here on
_SPACE = np.array([chr(c).isspace() for c in range(_KNOWN)] + [False])
_STOP = np.array([chr(c) in STOPS for c in range(_KNOWN)] + [False])


def _points(text: str) -> np.ndarray:
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


# Longer texts get their powers when they come.
_RAISED, _LOWERED = _powers(_BASE, CHUNK), _powers(_INVERSE, CHUNK)


def _hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of *values*, the same wherever the stretch lies."""
    n = len(values)
    raised, lowered = (_RAISED[:n], _LOWERED) if n < CHUNK else (_powers(_BASE, n), _powers(_INVERSE, n + 1))
    prefix = np.zeros(n + 1, np.uint64)
    terms = values + np.uint64(1)
    terms *= raised
    np.cumsum(terms, out=prefix[1:])
    value = (prefix[ends] - prefix[starts]) * lowered[starts]
    value = (value ^ (value >> np.uint64(32))) * _BASE + (ends - starts).astype(np.uint64)
    return (value ^ (value >> np.uint64(29))) * _INVERSE


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each *width* values in a row lies, the first of equal ones."""
    at, least, seen = np.arange(len(values)), values, 1
    while seen < width:
        step = min(seen, width - seen)
        at = np.where(least[step:] < least[:-step], at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        seen += step
    return at


def _cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The number of sentences of each text; of each sentence where it begins (in characters of its text), its
    number of words, and the hash of its words.
    """
    # Line ends between the texts close sentences, as others do, so that no sentence goes beyond its text.
    joined = "\n".join(texts)
    points, size = _points(joined), len(joined)
    if not joined.isascii():
        points = np.minimum(points, _KNOWN)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.cumsum(lengths + 1) - lengths - 1
    space, stop = _SPACE[points], _STOP[points]
    # A word ends before white space and behind stops.
    turns = space[:-1] | (stop[:-1] & ~stop[1:])
    starts = np.flatnonzero(~space & np.concatenate([[True], turns])[:size])
    turns = space[1:] | (stop[:-1] & ~stop[1:])
    ends = np.flatnonzero(~space & np.concatenate([turns, [True]])[:size]) + 1
    lower = joined.lower() if joined.isascii() else "\n".join(map(_lower, texts))
    words = _hashes(_points(lower), starts, ends)

    n = len(words)
    opens = np.zeros(n, bool)
    opens[1:] = stop[ends[:-1] - 1]
    below = np.searchsorted(starts, np.flatnonzero(points == 10))
    opens[below[below < n]] = True
    opens[:1] = True
    first = np.flatnonzero(opens)
    sizes = np.diff(first, append=n)
    windows = np.where(sizes > MOST_WORDS, sizes - WINDOW + 1, 0)
    at = np.repeat(first - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
    if len(at):
        opens[_least(words, WINDOW)[at]] = True
        first = np.flatnonzero(opens)

    # White space alone is a sentence without words.
    heads = np.searchsorted(starts, np.append(offsets, size))
    counts = np.diff(np.searchsorted(first, heads))
    blank = (counts == 0) & (lengths > 0)
    if blank.any():
        counts[blank] = 1
        first = np.sort(np.concatenate([first, heads[:-1][blank]]))
    last = np.append(first[1:], n)
    begins = np.append(starts, 0)[first] - np.repeat(offsets, counts)
    begins[(np.cumsum(counts) - counts)[counts > 0]] = 0
    return counts, begins, last - first, _hashes(words, first, last)


def sentences(text: str) -> tuple[list[str], list[int]]:
    """Consecutive pieces that make up the whole text, and the number of words in each."""
    _, begins, words, _ = _cut([text])
    ends = [*begins[1:].tolist(), len(text)]
    return [text[a:b] for a, b in zip(begins.tolist(), ends, strict=True)] if len(begins) else [], words.tolist()


def _spans(counts: np.ndarray, words: np.ndarray, run: int, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of spans of each text, whose first sentences these spans begin at, and the first and last sentence
    (exclusive) of each span.
    """
    total = np.concatenate([[0], np.cumsum(words)])
    start = np.arange(len(words))
    end = np.maximum(start + run, np.searchsorted(total, total[:-1] + least_words))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    fits = end <= np.repeat(bounds[1:], counts)
    return np.diff(np.concatenate([[0], np.cumsum(fits)])[bounds]), start[fits], end[fits]


def _chunks(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in their order, some at a time, empty ones for null."""
    held, size = [], 0
    for text in texts.to_pylist():
        text = text or ""
        if held and size + len(text) >= CHUNK:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield held


def _parts(run: int, least_words: int):
    @F.arrow_udf("array<long>")
    def parts(texts: pa.Array) -> pa.Array:
        numbers, hashes = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)]
        for chunk in _chunks(texts):
            counts, _, words, each = _cut(chunk)
            number, start, end = _spans(counts, words, run, least_words)
            numbers.append(number)
            hashes.append(_hashes(each, start, end))
        offsets = np.cumsum(np.concatenate(numbers)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(hashes).view(np.int64)))

    return parts


def _rest(run: int, least_words: int):
    @F.arrow_udf("text string, n_sentences long, n_removed long")
    def rest(texts: pa.Array, marks: pa.Array) -> pa.Array:
        left, numbers, removed = texts.to_pylist(), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        marked = pc.fill_null(pc.list_value_length(marks), 0).to_numpy(zero_copy_only=False)
        places, upto = marks.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(marked)])
        done = 0
        for chunk in _chunks(texts):
            counts, begins, words, _ = _cut(chunk)
            _, start, end = _spans(counts, words, run, least_words)
            here = slice(done, done + len(chunk))
            bounds = np.concatenate([[0], np.cumsum(counts)])
            hit = np.zeros(len(words), bool)
            pos = places[upto[done] : upto[here.stop]]
            owner = np.repeat(np.arange(len(chunk)), marked[here])
            hit[(bounds[owner] + pos)[pos < counts[owner]]] = True
            hit = hit[start]
            change = np.bincount(start[hit], minlength=len(words) + 1) - np.bincount(end[hit], minlength=len(words) + 1)
            gone = np.cumsum(change[:-1]) > 0
            number = np.diff(np.concatenate([[0], np.cumsum(gone)])[bounds])
            for k in np.flatnonzero(number).tolist():
                own = slice(bounds[k], bounds[k + 1])
                turns = np.flatnonzero(np.diff(np.concatenate([[True], gone[own], [True]])))  # kept stretches begin and end
                edges = np.append(begins[own], len(chunk[k]))[turns].tolist()
                left[done + k] = "".join(chunk[k][a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            numbers.append(counts)
            removed.append(number)
            done = here.stop
        columns = [pa.array(left, pa.string()), pa.array(np.concatenate(numbers)), pa.array(np.concatenate(removed))]
        return pa.StructArray.from_arrays(columns, ["text", "n_sentences", "n_removed"])

    return rest


def remove_repeated_spans(docs: DataFrame, run: int = 3, least_words: int = 20) -> DataFrame:
    """*docs* with the repeated sentences removed from ``text``, and n_sentences and n_removed.

    Incoming columns of the names n_sentences and n_removed give way.
    """
    # The hash of the text tells rows of one doc_id apart; it shares a long with the position.
    own = F.shiftleft(F.xxhash64("text"), 32)
    found = (
        small_batches(docs)
        .select(F.col("doc_id").alias("id"), own.alias("own"), _parts(run, least_words)("text").alias("parts"))
        # The outer form, as Spark would filter texts by the size of the plain one's array, and cut them once more for it.
        .select("id", "own", F.posexplode_outer("parts").alias("pos", "h"))
        .where("h is not null")
        .select("h", "id", F.col("own").bitwiseOR(F.col("pos").cast("long")).alias("at"))
    )
    # Written, so that both sides of the join are shuffled for it, and a frequent span can be split.
    firsts = stage(
        found.groupBy("h")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "at")).alias("first"))
        .where("n > 1")
        .select("h", F.col("first.id").alias("first_id"), F.col("first.at").alias("first_at")),
        "first-spans",
    )
    later = (
        found.join(firsts, "h")
        .where(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("at") == F.col("first_at"))))
        .select("id", F.shiftright("at", 32).alias("own"), F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("pos"))
        .groupBy("id", "own")
        .agg(F.collect_set("pos").alias("marks"))
    )
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.col("doc_id").alias("key_id"),
        F.shiftright(F.shiftleft(F.xxhash64("text"), 32), 32).alias("key_own"),
    )
    joined = whole.join(later, whole["key_id"].eqNullSafe(later["id"]) & (whole["key_own"] == later["own"]), "left")
    out = joined.select("doc", _rest(run, least_words)(F.col("doc.text"), F.col("marks")).alias("new"))
    names = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    return out.select(
        *((F.col("new.text") if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in names),
        F.col("new.n_sentences").alias("n_sentences"),
        F.col("new.n_removed").alias("n_removed"),
    )
