"""Packing: exact tokens, every constraint, and no worse than plain best fit decreasing."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodeworks.llm.packing import Words, encode_text, make_plan, pack, pieces, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


def best_fit(lengths, tokens):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, left in enumerate(bins) if left >= n]
        if fits:
            bins[min(fits, key=lambda k: bins[k])] -= n
        else:
            bins.append(tokens - n)
    return len(bins)


def check(packed, tokens):
    placed = defaultdict(list)
    for r in packed:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= tokens
    return len(placed)


def test_tokens_and_packing_of_all_documents(documents):
    cut = pieces(documents, PATH)
    packed = pack(cut.withColumn("ids_crc32", F.crc32("ids"))).collect()
    tokenizer = Tokenizer.from_file(PATH)
    expected = Counter()
    for r in documents.collect():
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], "<u4")
            expected[(r.doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected
    used = check(packed, 4096)
    assert used <= best_fit([r.length for r in packed], 4096)
    assert used <= 1.02 * sum(r.length for r in packed) / 4096 + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(spark, rule):
    rng = np.random.default_rng(5)
    lengths = [int(x) for x in rng.integers(1, 60, 3000)] + [7] * 1500
    items = spark.createDataFrame([(n,) for n in lengths], "length long")
    packed = pack(items, 100, 6, 4000, (1.0, 0.5, 0.5), rule).collect()
    assert Counter(r.length for r in packed) == Counter(lengths)
    check(packed, 100)
    by_bin = defaultdict(list)
    for r in packed:
        by_bin[r.sequence_id].append(r.length)
    assert max(map(len, by_bin.values())) <= 6
    assert max(sum(n * n for n in x) for x in by_bin.values()) <= 4000


def one_by_one(lengths, full, rule):
    """What is left of the bins' capacities when items are placed one by one."""
    bins, size = np.empty((0, 3), np.int64), np.array(full)
    for n in sorted(lengths, reverse=True):
        demand = np.array([n, 1, n * n])
        fits = np.flatnonzero((bins >= demand).all(axis=1))
        if rule == "norm":
            score = -(((bins[fits] - demand) / size) ** 2).sum(axis=1)
        else:
            score = ((bins[fits] / size) * (demand / size)).sum(axis=1)
        if len(fits):
            bins[fits[np.argmax(score)]] -= demand
        else:
            bins = np.vstack([bins, size - demand])
    return Counter(map(tuple, bins.tolist()))


@pytest.mark.parametrize("full", [(100, 100, 10_000), (100, 6, 4_000)])
@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_bins_are_chosen_by_all_residuals(rule, full):
    rng = np.random.default_rng(3)
    histogram = sorted(Counter(int(x) for x in rng.integers(1, 60, 900) ** 2 // 60 + 1).items())
    lengths = [n for n, count in histogram for _ in range(count)]
    plan, used = make_plan(histogram, *full, rule=rule), defaultdict(lambda: np.array(full))
    for n, count in histogram:
        for k in plan.places(np.full(count, n), np.arange(count))[0].tolist():
            used[k] = used[k] - [n, 1, n * n]
    assert Counter(tuple(x.tolist()) for x in used.values()) == one_by_one(lengths, full, rule)
    assert len(used) == plan.sequences


@pytest.mark.parametrize("documents, attention", [(100, 10_000), (4096, 4096 * 4096)])
def test_capacities_that_do_not_bind_still_count(spark, documents, attention):
    """By tokens alone the last item would go to the two of 41."""
    items = spark.createDataFrame([(n,) for n in (81, 41, 41, 10)], "length long")
    rows = pack(items, 100, documents, attention, weights=(1.0, 1.0, attention / 10_000)).collect()
    assert {r.length for r in rows if r.sequence_id == next(x.sequence_id for x in rows if x.length == 10)} == {81, 10}


def test_plan_does_not_grow_with_counts():
    histogram = [(n, 3 + n % 5) for n in range(1, 200)]
    small = make_plan(histogram, 200, 200, 40_000)
    large = make_plan([(n, 1000 * c) for n, c in histogram], 200, 200, 40_000)
    assert len(large.start) < 3 * len(small.start)


def test_hot_length_is_split(spark, monkeypatch):
    monkeypatch.setattr("lodeworks.llm.packing.SHARD_ROWS", 100)
    items = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 9 ELSE id % 50 + 1 END AS length")
    assert check(pack(items, 64).collect(), 64) > 0


def test_refused_items(spark):
    for length in (0, 101, None):
        with pytest.raises(ValueError, match="does not fit"):
            pack(spark.createDataFrame([(length,)], "length long"), 100)


def test_words_with_marks_and_accents():
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["Été. NAÏVE, e\u0301te\u0301 ΣΑΣ Σ. don't I'LL x.y, ... , . 3,5 ß İstanbul ﬁn ½ a\u00a0b\u2028c ǅ ªº. <|endoftext|>. Ελλάς, \u1e9e"]
    texts += [" ".join(w[::-1] for w in texts[0].split()), "\x85a\x1cb\x0bc"]
    for text in texts:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert encode_text(text, PATH, 1) == np.array(ids, "<u4").tobytes()


def test_whole_sequences(documents):
    packed = pack(pieces(documents.where("doc_id < 50"), PATH, 512), 512)
    for r in sequences(packed).collect():
        assert len(r.ids) == 4 * r.length <= 4 * 512


def test_odd_rows(odd_documents, no_documents):
    tokenizer = Tokenizer.from_file(PATH)
    cut = pieces(odd_documents, PATH)
    ids = defaultdict(bytes)
    for r in cut.orderBy("doc_id", "piece").collect():
        if r.doc_id not in (None, 6):
            ids[r.doc_id] += bytes(r.ids)
    for r in odd_documents.collect():
        if r.doc_id in ids:
            whole = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
            assert ids[r.doc_id] == np.array(whole, "<u4").tobytes()
    packed = pack(cut.withColumn("offset", F.lit(-1)))
    assert packed.count() == cut.count()
    assert "offset" in packed.columns
    check(packed.collect(), 4096)
    assert pack(pieces(no_documents, PATH)).collect() == []


def test_known_words_are_bounded_by_their_bytes():
    words = Words(PATH, budget=20_000)
    once = Words(PATH)
    for k in range(300):
        text = f"The word number{chr(97 + k % 26)}, and Other{'xyz'[k % 3] * (k % 40)}. ok {k}"
        assert words.text(text, 1) == once.text(text, 1)
        words.trim()
        assert words.held <= 20_000 and len(words.older) <= 2 * 20_000 / Words.ENTRY
