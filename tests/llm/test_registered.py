"""Registered queries against their SQL, and the stages of the pipeline against each other."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from lodeworks.llm import near_duplicates, repeated_spans, toxicity
from lodeworks.llm.queries import QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()
WITH_SQL = [name for name, (_, sql) in QUERIES.items() if sql]


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(oracle_sql()) & set(QUERIES) == set(WITH_SQL)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_sql(spark, sf, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    found = queries()[name](spark, sf)
    duck.execute(oracle_sql()[name])
    columns = [c[0] for c in duck.description]
    expected = duck.fetchall()
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(expected, key=repr)


def test_stages(spark, sf, documents):
    docs, kept = documents, [documents]
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(step(spark, docs, sf).collect(), documents.schema)
        assert docs.columns == documents.columns
        kept.append(docs)
    ids = [{r.doc_id for r in d.collect()} for d in kept]
    model = toxicity.train(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    assert ids[0] - ids[1] == {r.doc_id for r in toxicity.score(documents, model).where("toxicity >= 0.5").collect()}
    assert ids[2] == {r.doc_id for r in near_duplicates.near_duplicates(kept[1]).where("kept").collect()}
    cut = {r.doc_id: r.text for r in repeated_spans.remove_repeated_spans(kept[2]).collect()}
    assert {r.doc_id: r.text for r in kept[3].collect()} == {d: t for d, t in cut.items() if d in ids[3]}
    assert all(not cut[d].strip() for d in ids[2] - ids[3])
    assert ids[4] <= ids[3]
    packed = corpus_pipeline.pack_sequences(spark, docs, sf)
    assert {r.doc_id for r in packed.collect()} == ids[4]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").isEmpty()


def test_stages_of_odd_rows(spark, sf, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, docs, sf)
            assert out.columns == corpus_pipeline.COLUMNS
            assert out.count() <= 3 * docs.count()
        corpus_pipeline.pack_sequences(spark, docs, sf).count()
