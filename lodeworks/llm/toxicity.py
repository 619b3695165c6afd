"""Toxicity of whole texts: fuzzy matches with a learned lexicon, weighed by their context.

Method. The lexicon holds words that mark toxic training documents and hardly occur in others: a word
needs so many toxic documents that chance explains at most one of all words counted. Near copies count once, told by the least hash of their word shingles. A non-deterministic Levenshtein
automaton over the trie of the lexicon is made deterministic state by state as words are read; it
accepts words within one edit of terms of 5 to 8 letters and two of longer ones. Variants that are more
often in clean than in toxic training documents are left out, all of them; the other
variants of a term stay matched, and weigh less the more of its variants were left out than were seen in toxic documents. Each match weighs less the more edits it has, and its
context decides: between quotation marks, or after words that report or name speech, it counts as a
quotation; next to another match or a word of address it counts as abuse. Sum and maximum of a document's
matches give the score by logistic regression.

Scale. Lexicon and coefficients are learned on at most *sample* labelled rows (those with the smallest
hashes), whose words bound the lexicon and the variants left out; scoring reads each text once, where it lies, without a shuffle.

Defined results. Null and empty texts score as documents without a match. Without labels of both kinds
the lexicon is empty, and every score is the smoothed share of toxic rows. Rows without doc_id are never
learned from. Repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections.abc import Collection, Iterable, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import Memo, held_out, small_batches, stage
from lodeworks.llm.near_duplicates import shingles

WORD = re.compile(r"[^\W_]+")
WINDOW = 4
STATES = 10_000
# Words that report, name or deny speech, and words that address somebody, in four languages.
REPORTING = frozenset(
    "said says saying called calls calling wrote writes quoted quote word words term terms slur insult "
    "sagte sagt nannte nennt wort dijo dice llama palabra dit disait appelle mot".split()
)
ADDRESS = frozenset("you your youre u du dich dein ihr tu te tus ustedes vous toi vos".split())
QUOTES = "\"“”„«»‘’'`"


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Levenshtein automaton of all terms at once, along their trie; deterministic states are made on demand."""

    def __init__(self, terms: Iterable[str], exact: Collection[str] = ()):
        self.exact = frozenset(exact)
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most = [0]  # edits that some term below allows
        for term in terms:
            node = 0
            self.most[0] = max(self.most[0], self._allowed(term))
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = self.children[node][letter]
                self.most[node] = max(self.most[node], self._allowed(term))
            self.term[node] = term
        self._clear()

    def _allowed(self, term: str) -> int:
        return 0 if term in self.exact else edits_allowed(term)

    def _clear(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, places: set[tuple[int, int]]) -> int:
        """The state of a set of (node, edits), with all that skipping letters of a term reaches."""
        todo, best = list(places), {}
        while todo:
            node, edits = todo.pop()
            if edits > self.most[node] or best.get(node, 9) <= edits:
                continue
            best[node] = edits
            todo.extend((child, edits + 1) for child in self.children[node].values())
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, letter: str) -> int:
        places = set()
        for node, edits in self.sets[state]:
            places.add((node, edits + 1))
            for other, child in self.children[node].items():
                places.add((child, edits + (other != letter)))
        out = self.moves[state][letter] = self._state(places)
        return out

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its edits and their number; the smaller term on a tie."""
        if len(self.sets) > STATES:
            self._clear()
        state, moves = self.start, self.moves
        for letter in word:
            following = moves[state].get(letter)
            state = self._move(state, letter) if following is None else following
            if not self.sets[state]:
                return None
        found = [
            (edits, self.term[node])
            for node, edits in self.sets[state]
            if self.term[node] is not None and edits <= self._allowed(self.term[node])
        ]
        return min(found)[::-1] if found else None


_in_use: dict = {"model": None}


@dataclass
class Model:
    weights: Mapping[str, float] = field(default_factory=dict)
    benign: frozenset = frozenset()
    exact: frozenset = frozenset()
    coefficients: tuple = (0.0, 0.0, 0.0)
    trust: Mapping[str, float] = field(default_factory=dict)  # of variants of a term; 1 where it is missing

    def words(self) -> Memo:
        # One cache per worker, for the model in use: workers outlive models.
        if _in_use["model"] is not self:
            match = Automaton(self.weights, self.exact).match
            _in_use.update(model=self, words=Memo(lambda word: None if word in self.benign else match(word)))
        return _in_use["words"]

    def hits(self, text: str | None) -> list[tuple[str, str, int, float]]:
        """(word, term, edits, weight in its context) of each match."""
        if not text or not self.weights:
            return []
        low = text.lower()
        words = WORD.findall(low)
        matched = list(map(self.words().__getitem__, words))
        at = [k for k, m in enumerate(matched) if m]
        if not at:
            return []
        spans = [m.span() for m in WORD.finditer(low)]
        out = []
        for k in at:
            term, edits = matched[k]
            weight = self.weights[term] * (1 - 0.25 * edits) * (self.trust.get(term, 1.0) if edits else 1.0)
            near = set(words[max(0, k - WINDOW) : k]) | set(words[k + 1 : k + 1 + WINDOW])
            start, end = spans[k]
            opened = low[max(0, start - 40) : start].rstrip(" ")[-1:] in QUOTES and start > 0
            closed = low[end : end + 40].lstrip(" .,!?")[:1] in QUOTES and bool(low[end : end + 40].lstrip(" .,!?"))
            reported = bool(REPORTING.intersection(words[max(0, k - WINDOW) : k]))
            if opened and closed or reported and (opened or closed):
                weight *= 0.15
            elif reported:
                weight *= 0.6
            if ADDRESS & near:
                weight *= 1.3
            if any(matched[j] for j in range(max(0, k - WINDOW), min(len(words), k + 1 + WINDOW)) if j != k):
                weight *= 1.2
            out.append((words[k], term, edits, weight))
        return out

    def features(self, text: str | None) -> tuple[float, float, list]:
        hits = self.hits(text)
        weights = [h[3] for h in hits]
        return math.log1p(sum(weights)), max(weights, default=0.0), hits

    def score(self, total: float, most: float) -> float:
        a, b, c = self.coefficients
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * total + c * most))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients of a ridge logistic regression by Newton's method; the constant is not shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    shrink = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    w = np.zeros(x.shape[1])
    w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + shrink @ (w - np.array([w[0], *[0] * (len(w) - 1)]))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + shrink, gradient)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _lexicon(training: DataFrame, size: int | None) -> dict[str, float]:
    """The terms that mark toxic documents, at most *size* if given, with weights of about 1."""

    @F.pandas_udf("words array<string>, copy long")
    def distinct_words(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            least = shingles(text, 3)[:1].view(np.int64).tolist()
            out.append((list(set(WORD.findall((text or "").lower()))), *(least or [0])))
        return pd.DataFrame(out, columns=["words", "copy"])

    rows = training.select("toxic", distinct_words("text").alias("d")).select("toxic", "d.copy", F.explode("d.words").alias("word"))
    per_copy = rows.groupBy("word", "copy").agg(F.max("toxic").alias("toxic"))
    counts = per_copy.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("clean"))
    kinds = rows.groupBy("toxic").agg(F.count_distinct("copy").alias("copies")).collect()
    kinds = {r["toxic"]: r["copies"] for r in kinds}
    if not kinds.get(1) or not kinds.get(0):
        return {}
    chance = kinds[1] / (kinds[0] + kinds[1])
    counts = stage(counts, "words")
    vocabulary = counts.count()
    needed = max(3, math.ceil(math.log(vocabulary + 1) / -math.log(chance)))
    ratio = kinds[0] / kinds[1]
    terms = (
        counts.where((F.col("bad") >= needed) & (F.col("bad") * ratio >= 20 * F.col("clean")) & (F.length("word") >= 3))
        .orderBy(F.desc("bad"), "word")
    )
    terms = (terms if size is None else terms.limit(size)).collect()
    return {r["word"]: max(0.1, 1 - 20 * r["clean"] / (r["bad"] * ratio)) for r in terms}


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, lexicon_size: int | None = None) -> Model:
    """A model from the rows of *labels* (doc_id, toxic) that are not held out, and their texts."""
    chosen = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col("toxic").cast("long").alias("toxic"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most *sample* pairs of numbers.
    training = stage(small_batches(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "training")
    model = Model(_lexicon(training, lexicon_size))
    variants = (
        _features(training, model)
        .select("toxic", F.explode("near").alias("n"))
        .groupBy("n.word", "n.term")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("clean"))
    )
    # At most the distinct words of the sample; all of them, so that no term loses its misspellings.
    benign = frozenset(r["word"] for r in variants.where("clean > bad").select("word").distinct().collect())
    sides = variants.groupBy("term").agg(F.count_if(F.expr("clean > bad")).alias("benign"), F.count_if(F.expr("clean <= bad")).alias("abuse"))
    trust = {r["term"]: (1 + r["abuse"]) / (1 + r["abuse"] + r["benign"]) for r in sides.where("benign > 0").collect()}
    model = Model(model.weights, benign, trust=trust)
    pairs = _features(training, model).select("toxic", "total", "most").toPandas()
    if len(pairs):
        y = pairs["toxic"].to_numpy(float)
        if model.weights:
            model.coefficients = tuple(_logistic(pairs[["total", "most"]].to_numpy(float), y).tolist())
        else:
            model.coefficients = (math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 0.0, 0.0)
    return model


def _features(training: DataFrame, model: Model) -> DataFrame:
    """Per training row: toxic, sum and maximum of its matches, and the misspelled words among them."""
    held = training.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("total double, most double, near array<struct<word:string,term:string>>")
    def seen(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            total, most, hits = held.value.features(text)
            out.append((total, most, [{"word": w, "term": t} for w, t in {h[:2] for h in hits if h[2]}]))
        return pd.DataFrame(out, columns=["total", "most", "near"])

    return training.select("toxic", seen("text").alias("s")).select("toxic", "s.*")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """*docs* with ``toxicity`` (0 to 1) and ``toxic_terms``; incoming columns of these names give way."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("toxicity double, toxic_terms int")
    def scored(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            total, most, hits = held.value.features(text)
            out.append((held.value.score(total, most), len(hits)))
        return pd.DataFrame(out, columns=["toxicity", "toxic_terms"])

    names = [f"`{c}`" for c in docs.columns if c not in ("toxicity", "toxic_terms")]
    return small_batches(docs).select(*names, scored("text").alias("scored_")).select(*names, "scored_.toxicity", "scored_.toxic_terms")
