"""The automaton against plain edit distance; scores on held-out rows and planted cases."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from lodeworks.llm.common import held_out
from lodeworks.llm.queries import op3_toxicity
from lodeworks.llm.toxicity import Automaton, Model, edits_allowed, score, train

TERMS = ["ab", "abcde", "abcdf", "bcdea", "abcdeabcd", "cabcdeabcd"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@given(st.text("abcdef", max_size=12))
def test_automaton_finds_the_nearest_term(word):
    near = [(distance(word, t), t) for t in TERMS if distance(word, t) <= edits_allowed(t)]
    assert Automaton(TERMS).match(word) == (min(near)[::-1] if near else None)


@pytest.fixture(scope="module")
def model(spark):
    root = "/root/testdata/sf0.1"
    return train(spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet"))


def test_held_out_accuracy(spark, sf, model):
    root = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    labels = spark.read.parquet(f"{root}/labels.parquet")
    rows = score(docs, model).join(labels, "doc_id").where(held_out(labels["doc_id"])).collect()
    assert len(rows) > 500
    # A few junk texts are labelled toxic without a word that tells them.
    assert sum(r.toxicity >= 0.5 and not r.toxic for r in rows) <= 0.002 * len(rows)
    assert sum(r.toxicity < 0.5 and r.toxic for r in rows) <= 0.15 * sum(r.toxic for r in rows)


def test_misspelled_terms_are_caught_and_quotations_weigh_less(spark, model):
    texts = [
        "and then you are an idiot and a moron they went",
        "and then you are an idiott and a morron they went",
        "the and of that it with for",
        'the book said "idiot" and then went on',
        "and the idiot then went on",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    direct, misspelled, clean, quoted, plain = (r.toxicity for r in score(docs, model).orderBy("doc_id").collect())
    assert min(direct, misspelled) > 0.5 > clean
    assert quoted < plain


def test_terms_with_many_benign_neighbours_keep_their_misspellings(spark):
    neighbours = ["lower", "loses", "closer", "poser", "lover"]
    filler = [f"f{chr(97 + k % 26)}{k}" for k in range(400)]
    rows = []
    for k in range(600):
        words = [filler[(k * 7 + j * 13) % 400] for j in range(12)]
        rows.append((k, " ".join([*words[:6], "loser" if k % 3 == 0 else neighbours[k % 5], *words[6:]]), int(k % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert "loser" in model.weights
    assert set(neighbours) <= model.benign
    assert [h[:3] for h in model.hits("a loserr here")] == [("loserr", "loser", 1)]
    assert model.hits("a closer lower poser") == []


def test_lexicon_holds_all_significant_terms(spark):
    terms = [f"bad{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(420)]
    rows = []
    for k in range(150):  # toxic texts hold the terms in different orders: near copies count once
        words = sorted(terms, key=lambda t: hash((k, *map(ord, t)))) if k % 3 == 0 else ["good", f"x{k}"]
        rows.append((k, f"u{k} v{k} " + " ".join(words), int(k % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert set(terms) <= set(model.weights)


def test_query_columns(spark, sf, documents):
    found = op3_toxicity(spark, sf)
    assert found.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert found.count() == documents.count()
    assert found.where("score < 0 OR score > 1 OR score IS NULL OR (score >= 0.5) <> (predicted = 1)").isEmpty()


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(k, k % 2) for k in range(9)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    for model in (train(odd_documents, labels), train(no_documents, labels), train(odd_documents, labels.limit(0))):
        rows = score(odd_documents, model).collect()
        assert len(rows) == odd_documents.count()
        assert all(0 <= r.toxicity <= 1 for r in rows)
        assert score(no_documents, model).collect() == []


def test_empty_model_has_no_matches():
    assert Model().hits("idiot") == []
