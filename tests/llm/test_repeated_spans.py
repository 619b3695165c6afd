"""Removal of repeated spans against a plain loop over all spans."""

import re

import numpy as np
import pyarrow as pa

from lodeworks.llm import repeated_spans
from lodeworks.llm.repeated_spans import _cut, _hashes, _lower, remove_repeated_spans, sentences


def brute_force(rows, run, least):
    seen, cut = {}, {}
    for doc_id, text in sorted(rows):
        pieces, words = sentences(text)
        real = [k for k, n in enumerate(words) if n]
        gone = set()
        for a in range(len(real)):
            b = a
            while b < len(real) and (b - a < run or sum(words[k] for k in real[a:b]) < least):
                b += 1
            if b - a >= run and sum(words[k] for k in real[a:b]) >= least:
                key = tuple(w for k in real[a:b] for w in [*pieces[k].lower().split(), None])
                if key in seen:
                    gone.update(range(real[a], real[b - 1] + 1))
                else:
                    seen[key] = doc_id
        cut[doc_id] = ("".join(p for k, p in enumerate(pieces) if k not in gone), len(pieces), len(gone))
    return cut


def test_all_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    found = remove_repeated_spans(documents).collect()
    assert {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in found} == brute_force(rows, 3, 20)


def test_sentences_make_up_the_text():
    for text in ["", " ", "a", " a. b!\n\nc ", "." * 5, " ".join(map(str, range(100))), "\n a b, c;d"]:
        pieces, words = sentences(text)
        assert "".join(pieces) == text
        assert sum(words) == len(text.split()) or "," in text or ";" in text
        assert max(words, default=0) <= 12


def test_planted_passage_goes_and_clean_text_stays(spark):
    passage = "This passage came first. It has some sentences, all of them with words; and it goes on until it is long enough."
    rows = [(1, f"Begin here now. {passage} The end of one."), (2, f"Another start: {passage} Another end."), (3, "Clean text. " * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in remove_repeated_spans(docs).collect()}
    assert found == {1: rows[0][1], 2: "Another start: Another end.", 3: rows[2][1]}


def test_passage_without_stops_goes_at_every_offset(spark):
    passage = " ".join(f"passage{k}" for k in range(51))
    rows = [(0, f"{passage} end")]
    for n in range(1, 40):  # n other words before it, and others behind it
        rows.append((n, " ".join([*(f"lead{n}x{k}" for k in range(n)), passage, *(f"tail{n}x{k}" for k in range(7))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in remove_repeated_spans(docs).collect():
        kept = r.text.split()
        left = sum(w.startswith("passage") for w in kept)
        assert left == 51 if r.doc_id == 0 else left <= 25, r.doc_id
        assert sum(w.startswith("lead") for w in kept) == r.doc_id
    assert max(max(sentences(text)[1]) for _, text in rows) <= 12


def test_odd_rows(odd_documents, no_documents):
    found = remove_repeated_spans(odd_documents)
    assert found.columns[: len(odd_documents.columns)] == odd_documents.columns
    rows = found.collect()
    assert len(rows) == odd_documents.count()
    before = {r.length: r for r in odd_documents.collect()}
    for r in rows:
        if r.doc_id == 5:
            assert r.n_removed == r.n_sentences > 1000
        elif r.doc_id == 4:
            assert r.n_removed > 0  # its own words repeat
        else:
            assert r.text == before[r.length].text
            assert r.n_removed == 0
    assert remove_repeated_spans(no_documents).collect() == []


def plain_cut(text):
    """Beginnings, numbers of words and words of the sentences of one text, by loops."""
    found = [(m.start(), m.group()) for m in re.finditer(r"(?:[^\s\x1c-\x1f.!?,;:])+[.!?,;:]*|[.!?,;:]+", text)]
    low = _lower(text)
    words = [low[at : at + len(word)] for at, word in found]
    value = [int(_hashes(np.array([ord(c) for c in w], np.uint64), np.array([0]), np.array([len(w)]))[0]) for w in words]
    ends = [at + len(word) for at, word in found]
    opens = [k for k in range(len(words)) if k == 0 or found[k - 1][1][-1] in ".!?,;:" or "\n" in text[ends[k - 1] : found[k][0]]]
    cuts = set(opens)
    for a, b in zip(opens, [*opens[1:], len(words)], strict=False):
        if b - a > 12:
            cuts |= {min(range(k, k + 10), key=value.__getitem__) for k in range(a, b - 9)}
    edges = [*sorted(cuts), len(words)]
    if not words:
        return [(0, [])] if text else []
    return [(found[a][0] if a else 0, words[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


ODD = ["", " ", "\n", "..", "a. b", "x y\n z", "ΑΣ ΑΣ. ς", "İx Kelvin K, k", "\x1c ퟿", "\U0001f600 a!b", "ends\n", " . ,"]


def test_texts_cut_together_have_the_sentences_of_each_alone(documents):
    words = [f"w{k * k % 7}" for k in range(90)]
    texts = [*ODD, " ".join(words), *reversed(ODD), ", ".join(words), *(r.text for r in documents.limit(40).collect())]
    for some in (texts, [t for t in texts if t.isascii()], ["", " ", "\n"], [""]):
        counts, begins, sizes, hashes = _cut(some)
        expected = [plain_cut(t) for t in some]
        assert counts.tolist() == [len(e) for e in expected]
        assert list(zip(begins.tolist(), sizes.tolist(), strict=True)) == [(a, len(w)) for e in expected for a, w in e]
        keys = [tuple(w) for e in expected for _, w in e]
        assert len(set(zip(keys, hashes.tolist(), strict=True))) == len(set(keys)) == len(set(hashes.tolist()))


def test_short_texts_are_hashed_together(monkeypatch, spark):
    calls = []
    monkeypatch.setattr(repeated_spans, "_hashes", lambda *args: calls.append(1) or _hashes(*args))
    found = repeated_spans._parts(3, 20).func(pa.array(["one two, three four, five six. " * 5, None, ""] * 200))
    assert [len(x) for x in found.to_pylist()] == [6, 0, 0] * 200
    assert len(calls) <= 6  # before, three for each text


def test_text_is_hashed_once_a_document_not_once_a_span(spark, monkeypatch):
    plans = []
    docs = spark.createDataFrame([(1, "one two, three four, five six. " * 5)], "doc_id long, text string")
    monkeypatch.setattr(repeated_spans, "stage", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    remove_repeated_spans(docs)
    lines = plans[0].splitlines()
    exploded = next(k for k, line in enumerate(lines) if "Generate" in line)
    assert not any("xxhash64" in line for line in lines[:exploded])
    assert any("xxhash64" in line for line in lines[exploded:])


def test_texts_are_cut_once_a_pass(spark, monkeypatch):
    plans = []
    docs = spark.createDataFrame([(1, "one two, three four, five six. " * 5)], "doc_id long, text string")
    monkeypatch.setattr(repeated_spans, "stage", lambda df, name: plans.append(df) or df)
    plans.append(remove_repeated_spans(docs))
    counts = [df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") for df in plans]
    assert counts == [1, 3]  # without a written table, the second plan holds the first
