"""Near duplicates against all pairs of shingle sets."""

import re

import pytest

from lodeworks.llm.common import components
from lodeworks.llm.near_duplicates import least_depth, near_duplicates


def brute_force(rows, words, percent):
    sets = {}
    for doc_id, text in rows:
        found = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        span = min(words, len(found))
        sets[doc_id] = {tuple(found[k : k + span]) for k in range(len(found) - span + 1)} if found else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and 100 * small >= percent * large:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (small + large - both):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {(d, len(sets[d]), find(d), find(d) == d) for d in ids}


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_all_documents(documents, words, percent):
    found = near_duplicates(documents, words=words, percent=percent)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert {tuple(r) for r in found.collect()} == brute_force(rows, words, percent)


@pytest.mark.parametrize(("region_rows", "block_rows"), [(4096, 16), (40, 16)])
def test_large_group_in_blocks(spark, region_rows, block_rows):
    base = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(base))]
    for n in range(1, 120):  # two words changed: similar to the base, hardly to each other
        text = list(base)
        text[n % 190] = f"x{n}"
        text[(n * 37) % 190] = f"y{n}"
        rows.append((n, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(docs, 3, 90, region_rows=region_rows, block_rows=block_rows).collect()
    assert {tuple(r) for r in found} == brute_force(rows, 3, 90)
    assert len({r.component_id for r in found}) < 120


def test_large_regions_miss_no_pairs(spark):
    rows = []
    for n in range(400):  # pairs near the threshold: 109 of 127 shingles in common
        text = [f"w{n}x{k}" for k in range(120)]
        rows.append((2 * n, " ".join(text)))
        for k in (30, 60, 90):
            text[k] = f"y{n}x{k}"
        rows.append((2 * n + 1, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(docs, 3, 85, region_rows=1).collect()
    assert {r.doc_id: r.component_id for r in found} == {d: d - d % 2 for d, _ in rows}


def test_odd_rows(odd_documents):
    found = near_duplicates(odd_documents, 3, 85).collect()
    assert len(found) == odd_documents.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert sorted(by_id[None], key=repr) == [(0, None, True), (4, None, True)]
    assert by_id[1] == by_id[2][:0] + [(0, 1, True)]
    assert by_id[3] == [(0, 3, True)]
    assert by_id[4][0][1:] == (4, True)
    assert by_id[5][0][1:] == (4, False)
    assert by_id[6] == [(1, 6, True)] * 2
    assert by_id[7] == [(1, 6, False)]


def test_no_rows(no_documents):
    assert near_duplicates(no_documents).collect() == []


def test_depth_keeps_the_chance_to_miss_low():
    assert least_depth(85, 12) == 4
    assert least_depth(80, 12) == 3


def test_components_of_a_chain(spark):
    edges = spark.range(1, 60).selectExpr("id AS a", "id - 1 AS b").union(spark.sql("SELECT 100L, 99L"))
    found = {tuple(r) for r in components(edges).collect()}
    assert found == {(k, 0) for k in range(60)} | {(99, 99), (100, 99)}
