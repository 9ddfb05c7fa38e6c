from __future__ import annotations

import random

import numpy as np

from tabforge.llm.components import connected_components
from tabforge.llm.near_dedup import fast_similarity_sketch, near_duplicates
from tests.llm.data import awkward_rows, documents, sentence


def shingles(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows: list[tuple]) -> dict:
    """Component of each id by comparing all pairs of texts."""
    sets = {i: shingles(t) for i, t, *_ in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(words: list[str], rng: random.Random, edits: int) -> str:
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def check(spark, rows):
    found = near_duplicates(documents(spark, rows)).collect()
    expected = brute_force(rows)
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_awkward_rows(spark):
    check(spark, [r for r in awkward_rows()])
    lonely = near_duplicates(documents(spark, [(None, "x y z"), (3, "x y z"), (None, "other words here")])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in lonely) == [("3", "3", True), ("None", "3", False), ("None", "None", True)]


def test_large_groups_of_copies_and_near_copies(spark):
    """Two families whose members resemble each other to any degree, with copies, so buckets are large and mixed."""
    rng, rows = random.Random(5), []
    for family in range(2):
        base = sentence(family, 160).split()
        rows += [(1000 * family + i, edited(base, rng, rng.choice((0, 1, 2, 3, 5, 8)))) for i in range(260)]
    rows += [(5000 + i, sentence(100 + i, 40)) for i in range(40)]
    rows += [(6000 + i, sentence(9, 50).upper()) for i in range(60)]
    rng.shuffle(rows)
    check(spark, rows)


def test_empty_table_and_clashing_columns(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    docs = documents(spark, [(1, "a b c d e f"), (2, "A b c d e f")]).selectExpr("*", "1 AS node", "2 AS bucket", "3 AS KEPT")
    assert [r["component_id"] for r in near_duplicates(docs).collect()] == [1, 1]


def test_sketch_fills_and_estimates(spark):
    rng = np.random.default_rng(0)
    for n in (1, 3, 50, 2000):
        assert (fast_similarity_sketch(rng.integers(0, 2**63, n).astype(np.uint64), 130) < np.iinfo(np.uint64).max).all()
    base = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = fast_similarity_sketch(base[:2500], 1000), fast_similarity_sketch(base[500:], 1000)
    assert abs((a == b).mean() - 2000 / 3000) < 0.06


def test_components_of_paths_and_stars(spark):
    edges = [(i + 1, i) for i in range(60)] + [(200, i) for i in range(100, 140)] + [(7, 7), (301, 300), (300, 302)]
    found = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {found[i] for i in range(61)} == {0}
    assert {found[i] for i in [*range(100, 140), 200]} == {100}
    assert found[302] == found[301] == 300
