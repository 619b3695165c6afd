"""Removal of repeated byte strings against a dictionary of all of them."""

import hashlib
import random
from pathlib import Path

import pytest

from lodeworks.llm import suffix_repeats
from lodeworks.llm.queries import op12_suffix_dedup
from lodeworks.llm.suffix_repeats import ranks, remove_repeats

SCHEMA = "doc_id long, text string"


def brute_force(rows, length):
    """Per (doc_id, text): bytes, removed, spans, digest of the rest."""

    def place(row):
        return row[0] is not None, row[0] or 0, hashlib.sha256(row[1]).hexdigest()

    texts = sorted({(d, (t or "").encode()) for d, t in rows}, key=place)
    first, out = {}, {}
    for at, (_, body) in enumerate(texts):
        for k in range(len(body) - length + 1):
            first.setdefault(body[k : k + length], (at, k))
    for at, (doc_id, body) in enumerate(texts):
        gone = bytearray(len(body))
        for k in range(len(body) - length + 1):
            if first[body[k : k + length]] != (at, k):
                gone[k : k + length] = b"\1" * length
        rest = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[doc_id, body] = (len(body), sum(gone), spans, rest)
    return sorted((str(d), *out[d, (t or "").encode()]) for d, t in rows)


def result(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.rest)) for r in df.collect())


@pytest.mark.parametrize(("length", "letters"), [(4, "ab"), (30, "abc")])
def test_small_alphabets(spark, length, letters):
    rng = random.Random(length)
    pool = ["".join(rng.choices(letters, k=rng.randint(3, 3 * length))) for _ in range(6)]
    rows = [(k, "".join(rng.choices([*pool, "é", "zyx"], k=rng.randint(0, 5)))) for k in range(40)]
    rows += [(100, "a" * (5 * length)), (101, "ab" * (3 * length)), (102, rows[0][1]), (3, rows[0][1]), (3, rows[3][1])]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(remove_repeats(frame, length)) == brute_force(rows, length)


def test_suffix_order(spark):
    """Ranks put all suffixes in the order of their first bytes, whatever text they are in."""
    rng = random.Random(5)
    bodies = [("".join(rng.choices("ab", k=n))).encode() for n in (1, 2, 7, 40, 41, 42, 90)]
    frame = spark.createDataFrame([(k, 0, bytearray(b)) for k, b in enumerate(bodies)], "doc long, at int, body binary")
    found = {r.doc: r.v for r in ranks(frame, 12).collect()}
    suffixes = [(rank, bodies[doc][k:][:12]) for doc, v in found.items() for k, rank in enumerate(v)]
    assert len(suffixes) == sum(map(len, bodies))
    assert [s for _, s in sorted(suffixes)] == sorted(s for _, s in suffixes)


def test_odd_documents(spark, odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    rows = [(d, t if t is None or len(t) < 5000 else t[:5000]) for d, t in rows]
    rows += [(None, "x" * 150), (None, "x" * 250), (20, "a b c d e f" * 20), (20, "a b c d e f" * 20)]
    frame = spark.createDataFrame([(*r, k, k, b"", 0) for k, r in enumerate(rows)], SCHEMA + ", doc long, at int, body binary, path int")
    assert result(remove_repeats(frame)) == brute_force(rows, 100)


def passages(n, seed):
    """Documents of random words, with a passage that all share and some that a few share, each in its own surroundings."""
    rng = random.Random(seed)

    def text(words):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(words))

    common, shared = text(40), [text(30) for _ in range(n // 8)]
    return [(k, text(rng.randint(0, 60)) + common[rng.randint(0, 20) :] + rng.choice(shared) + text(rng.randint(0, 60))) for k in range(n)]


def test_runs_across_partitions(spark, monkeypatch):
    """Runs of an order that begin and end in other partitions, or go through several, are one branch."""
    monkeypatch.setattr(suffix_repeats, "_ORDERED", 25)
    rows = passages(60, 3)
    rows += [(k, rows[k % 7][1]) for k in (1, 70, 71)] + [(80, "ab" * 120), (81, "c" + "ab" * 90)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(remove_repeats(frame)) == brute_force(rows, 100)


def test_rows_are_places(spark):
    """What is staged on the way is of the input's size, as rows are a seed's, not a byte's; settings are left as they were."""
    rows = passages(600, 4)
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))

    def staged():
        return {p: p.stat().st_size for p in folder.rglob("*.parquet")}

    before, conf = staged(), spark.conf.get(suffix_repeats._CLEANUP, None)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert result(remove_repeats(frame)) == brute_force(rows, 100)
    assert sum(size for p, size in staged().items() if p not in before) < 3 * sum(len(t) for _, t in rows)
    assert spark.conf.get(suffix_repeats._CLEANUP, None) == conf


def test_empty_table(spark, no_documents):
    assert remove_repeats(no_documents).collect() == []


def test_all_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = op12_suffix_dedup(spark, sf)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    expected = [(*r[:-1], hashlib.sha256(r[-1]).hexdigest()) for r in brute_force(rows, 100)]
    assert sorted((str(r.doc_id), *r[1:]) for r in found.collect()) == sorted(expected)
    assert sum(r[2] for r in expected) > 0
