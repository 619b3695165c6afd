"""The filter audit against a plain loop over documents and orders."""

import itertools
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lodeworks.llm import filter_audit
from lodeworks.llm.common import stage
from lodeworks.llm.filter_audit import audit, failures, term_matrix
from pyspark.sql import functions as F

LABELS = "doc_id long, quality int, toxic int"


def failed(docs):
    """The failed filters of each (doc_id, lang, text)."""
    out = []
    for doc_id, _, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = "A" if len(words) < 100 else ""
        bad += "B" if 100 * len(set(words)) < 80 * len(words) else ""
        bad += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
        bad += "D" if re.search(r"[#$%&*|]", text) else ""
        bad += "E" if any(o is not None and doc_id is not None and o < doc_id and (t or "") == text for o, _, t in docs) else ""
        out.append(bad)
    return out


def brute_force(docs, labels):
    bad = failed(docs)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for part in {lang or "" for _, lang, _ in docs}:
        mine = [(d[0], b) for d, b in zip(docs, bad, strict=True) if (d[1] or "") == part]
        own = []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                out = [d for d, b in left if f in b]
                fails = sum(f in b for _, b in mine)
                left = [(d, b) for d, b in left if f not in b]
                own.append(
                    (part, "".join(order), step, len(left), len(out), fails - len(out), sum(b == f for _, b in mine),
                     sum(d in good for d in out), sum(d in toxic for d in out))
                )
        rows += [(*r, sum(o[4] for o in own if o[1][o[2] - 1] == r[1][r[2] - 1])) for r in own]
    return sorted(rows)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.mark.parametrize("shard_bytes", [1, 300, 1 << 20])
def test_odd_documents(spark, odd_documents, monkeypatch, shard_bytes):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(filter_audit, "BUCKET_WORDS", 100)
    few = [(9, "x y   " + "Wé\x1c" * 3, None), (10, "A B C D", "de"), (11, "b " * 200, "de"), (None, "", "de"), (12, "A B C D", "de")]
    extra = spark.createDataFrame([(d, t, g, None, 1, 1, "x", 0.5, 7, "y") for d, t, g in few], odd_documents.schema)
    docs = odd_documents.withColumnRenamed("kept", "part").withColumnRenamed("h", "digest").union(extra)
    labels = [(1, 1, 0), (4, 1, 1), (4, 0, 0), (5, 1, 0), (5, 1, 0), (7, None, 1), (None, 1, 1), (99, 1, 1), (12, 1, None)]
    plain = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    found = audit(docs.repartition(3), spark.createDataFrame(labels, LABELS))
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == brute_force(plain, labels)
    each = failures(docs.repartition(2)).collect()
    assert sorted((str(r.doc_id), "".join(f for f in "ABCDE" if r[f])) for r in each) == sorted(
        (str(d[0]), b) for d, b in zip(plain, failed(plain), strict=True)
    )


def test_matrix_has_all_words(spark, documents, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 50_000)
    monkeypatch.setattr(filter_audit, "BUCKET_WORDS", 3_000)
    few = documents.limit(200).repartition(3)
    dictionary, shards, rows = term_matrix(few, {"doc_id": F.col("doc_id")})
    words = {r.term: r.word for r in dictionary.collect()}
    expected = {r.doc_id: r.text.encode().split() for r in documents.limit(200).collect()}
    assert sorted(words) == list(range(len(words)))
    assert sorted(words.values()) == sorted({w.decode() for text in expected.values() for w in text})
    keys = {r.shard: r.doc_id for r in rows.collect()}
    seen = 0
    for r in shards.collect():
        for at, doc_id in enumerate(keys[r.shard]):
            span = slice(r.starts[at], r.starts[at + 1])
            entries = [(words[t], n) for t, n in zip(r.terms[span], r.counts[span], strict=True)]
            assert sorted(w for w, n in entries for _ in range(n)) == sorted(w.decode() for w in expected[doc_id])
            assert len({w for w, _ in entries}) == len(entries)
            seen += 1
    assert seen == len(expected)


def test_a_task_holds_few_shards(spark, documents, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 20_000)
    staged = {}
    monkeypatch.setattr(filter_audit, "stage", lambda df, name, *a, **b: staged.setdefault(name, stage(df, name, *a, **b)))
    _, shards, _ = term_matrix(documents.limit(200).coalesce(1), {"doc_id": F.col("doc_id")})
    files = [pq.ParquetFile(path.removeprefix("file://")).metadata for path in staged["shards"].inputFiles()]
    assert sum(f.num_rows for f in files) > 3
    assert all(f.num_row_groups == f.num_rows for f in files)
    batches = pa.RecordBatch.from_pylist(
        [{"shard": k, "starts": [0, 2], "terms": [1, 0], "counts": [3, 4], "pieces": [{"part": 5, "own": [1, 0], "slots": [7, 9]}]} for k in (1, 2)]
    )
    out = [b.to_pylist() for b in filter_audit._remapped({5: 100}, [batches])]
    assert out == [[{"shard": k, "starts": [0, 2], "terms": [107, 109], "counts": [3, 4]}] for k in (1, 2)]
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == f"{8 << 20}b"
    assert shards.count() == sum(f.num_rows for f in files)


def test_empty_tables(spark, no_documents):
    labels = spark.createDataFrame([], LABELS)
    assert audit(no_documents, labels).collect() == []
    one = spark.createDataFrame([(1, None, None, "s", 0)], no_documents.schema)
    assert sorted(map(tuple, audit(one, labels).collect())) == brute_force([(1, None, None)], [])
