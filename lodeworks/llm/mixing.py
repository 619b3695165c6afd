"""Mixing sources to target weights by Poisson replication.

Method. A source with n rows and a share w of a mixture of *total* rows is repeated w * total / n times in
the mean. Each row draws its number of copies by inverting the Poisson distribution of that mean at a
number in (0, 1) that a hash of seed and doc_id gives, is exploded by it, and all copies are shuffled
by a hash of seed, doc_id and copy. Means above 500 are a sum of several draws, as exp(-mean) would vanish.

Scale. The only state is one row per source, which is written: its real size decides whether it is broadcast.
Then rows are dealt out by the hash only. Beyond the broadcast threshold they meet the rates by source, in a join
whose two sides are shuffled for it, so that a source with a third of all rows is split. Every draw
depends on its row alone, so a lost task draws the same again.

Defined results. A null source is a source. Rows with equal doc_id draw alike, repeated rows too. A null
doc_id draws as the empty text. Sources that *weights* leaves out get the weight 0; a source without rows
hands its share to the others. Other columns are handed on; incoming ones named mix_copy, mix_rate or
mix_key give way. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import stage

ADDED = ("mix_copy", "mix_rate", "mix_key")
LARGEST = 500.0


def _digest(seed: int, *parts) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))


def _uniform(digest: Column) -> Column:
    """A number in (0, 1) from the first 52 bits."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2**52))


def _cumulative(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until far beyond the mean, for X of a Poisson distribution."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    first = F.struct(
        F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all")
    )

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), (state["c"] + p).alias("c"), F.concat(state["all"], F.array(state["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), first, step)["all"]


def rates(docs: DataFrame, weights: Mapping[str | None, float] | None, power: float, total: int | None) -> DataFrame:
    """Per source: its mean number of copies."""
    sources = docs.groupBy(F.col("source").alias("mix_source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n"), F.lit(power))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("mix_source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    sums = sources.agg(F.sum("n"), F.sum(weight)).first()
    rows, all_weights = total if total is not None else sums[0] or 0, sums[1] or 1.0
    return sources.select("mix_source", (weight / F.lit(float(all_weights)) * F.lit(float(rows)) / F.col("n")).alias("rate"))


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    power: float = 0.7,
    total: int | None = None,
    seed: int = 17,
) -> DataFrame:
    """*docs* repeated to the target weights and shuffled, with mix_copy (from 1), mix_rate and mix_key.

    Without *weights* a source weighs its number of rows to the *power*; without *total* the mixture is
    as large as *docs* in the mean.
    """
    # Tables of the draws are held once per source and looked up by each row.
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST)).cast("int")
    by_source = rates(docs, weights, power, total).select(
        "mix_source", "rate", draws.alias("draws"), _cumulative(F.col("rate") / draws).alias("upto")
    )
    by_source = stage(by_source, "rates")
    doc_id = F.coalesce(F.col("doc.doc_id").cast("string"), F.lit(""))

    def drawn(k: Column) -> Column:
        u = _uniform(_digest(seed, k.cast("string"), doc_id))
        return F.size(F.filter("upto", lambda c: c < u))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("draws")), F.lit(0), lambda n, k: n + drawn(k))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col("source").alias("own_source"))
    return (
        whole.join(by_source, F.col("own_source").eqNullSafe(F.col("mix_source")))
        .withColumn("copies", copies)
        .where("copies > 0")
        .select("doc", "rate", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select(
            *(F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in ADDED),
            F.col("copy").alias("mix_copy"),
            F.col("rate").alias("mix_rate"),
            _digest(seed, F.lit("order"), doc_id, F.col("copy").cast("string")).alias("mix_key"),
        )
        .repartition("mix_key")
        .sortWithinPartitions("mix_key")
    )
