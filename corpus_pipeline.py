"""A corpus pipeline of five stages; each works on all that the one before kept.

All but the last return the columns of documents; extra columns are dropped, whatever their names. A null text is
handled as an empty one and stays null, an empty text is not toxic, no near duplicate, and a piece of one token. A null
doc_id is an id like others: its rows are packed, and come first where the order of ids decides. Of near duplicates the
smallest doc_id stays; rows that share doc_id and text go through alike, so that ties need no order. Very long texts
are handled whole. An empty table stays empty in every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm import mixing, near_duplicates, packing, repeated_spans, toxicity
from lodeworks.llm.common import stage, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that do not score as toxic, by a model of the labels."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("toxicity < 0.5").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id."""
    found = near_duplicates.near_duplicates(docs)
    kept = found.where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select(COLUMNS)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences that an earlier document has in a repeated span; n_chars follows.

    Documents of which nothing but white space is left go, if something was removed.
    """
    cleaned = repeated_spans.remove_repeated_spans(docs)
    emptied = (F.col("n_removed") > 0) & (F.trim(F.regexp_replace("text", r"\s", "")) == "")
    return (
        cleaned.where(~F.coalesce(emptied, F.lit(False)))
        .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(COLUMNS)
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources approach their target weights."""
    return mixing.mix(docs).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences."""
    pieces = packing.pieces(docs, TOKENIZER)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_spans),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Learned scores, MinHash links and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of *sf_dir*; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
