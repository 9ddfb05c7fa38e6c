from __future__ import annotations

import numpy as np
import pytest

from tabforge.llm import vptree as vp

SCHEMA = "vec_id long, embedding array<float>"


def brute_force(rows: list[tuple], queries: list[tuple], k: int) -> list[tuple]:
    def good(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and good(v)]
    found = []
    for q, v in ((i, np.array(v, np.float32).astype(float)) for i, v in queries if i is not None and good(v)):
        scores = [(-(vp.dots(v[None], c[None])[0, 0] / (np.sqrt(vp.dots(v[None], v[None])[0, 0]) * np.sqrt(vp.dots(c[None], c[None])[0, 0]))), i) for i, c in usable if i != q and len(c) == len(v)]
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def clustered(n: int, d: int = 16, seed: int = 0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, d))
    return [(i, (centres[i % 8] + rng.normal(size=d) * (0.1 if i % 3 else 1.5)).tolist()) for i in range(n)]


def search(spark, rows, queries, k=5, **options):
    index = vp.build_index(spark.createDataFrame(rows, SCHEMA), shard_rows=options.pop("shard_rows", 150), leaf=16)
    return sorted(map(tuple, vp.search_index(index, spark.createDataFrame(queries, SCHEMA), k=k, block=20, **options).collect()))


def test_factor_one_is_exact(spark):
    rows = clustered(700)
    found = search(spark, rows, rows[::10])
    expected = brute_force(rows, rows[::10], 5)
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    assert [f[3] for f in found] == pytest.approx([e[3] for e in expected], abs=1e-14)


def test_recall_of_relaxed_pruning(spark):
    rows = clustered(900, seed=3)
    expected = {e[::2] for e in brute_force(rows, rows[::9], 5)}
    recalls = [len(expected & {f[::2] for f in search(spark, rows, rows[::9], relax=r)}) / len(expected) for r in (0.9, 0.6)]
    assert recalls[0] >= 0.98 and recalls[1] >= 0.9


def test_ties_copies_and_vectors_that_take_no_part(spark):
    same = [0.5, -1.0, 2.0]
    rows = [(i, same) for i in range(400, 0, -1)] + [(1000 + i, [1.0, i + 1.0, 0.0]) for i in range(5)]
    rows += [(2000, None), (2001, []), (2002, [0.0, 0.0, 0.0]), (2003, [1.0, None, 0.0]), (2004, [float("nan"), 1.0, 1.0]), (2005, [float("inf"), 1.0, 1.0])]
    rows += [(None, same), (3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (3002, [9.0])]
    queries = [r for r in rows if r[0] in (1, 3, 200, 1002, 2000, 2002, 2004, 3000, 3002)]
    found = search(spark, rows, queries)
    assert [f[2] for f in found if f[0] == 3] == [1, 2, 4, 5, 6]
    assert [f[:3] for f in found] == [e[:3] for e in brute_force(rows, queries, 5)]
    assert {f[0] for f in found} == {1, 3, 200, 1002, 3000}


def test_repeated_ids_count_once(spark):
    rng = np.random.default_rng(1)
    rows = [(0, [1.0, 0.0, 0.1])] + [(7, [1.0, 0.01 * i, 0.0]) for i in range(6)] + [(i, rng.normal(size=3).tolist()) for i in range(10, 16)]
    rows += [(8, rng.normal(size=3).tolist()) for _ in range(300)]
    found = search(spark, rows, [rows[0], rows[1], rows[2]], shard_rows=10_000)
    assert [f[1] for f in found if f[0] == 0] == [1, 2, 3, 4, 5]
    assert len({f[2] for f in found if f[0] == 0}) == 5
    best = {}
    for q, v in (rows[0], rows[1], rows[2]):
        for _, _, i, s in brute_force(rows, [(q, v)], 10**6):
            best[q, i] = max(s, best.get((q, i), -2))
    for q in (0, 7):
        top = sorted(((-s, i) for (own, i), s in best.items() if own == q))[:5]
        assert [(f[2], f[3]) for f in found if f[0] == q] == [(i, pytest.approx(-s, abs=1e-14)) for s, i in top]


def test_fewer_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (51, [1.0, 1.0])]
    assert len(search(spark, rows, rows[:2])) == 4
    assert search(spark, [], []) == [] and search(spark, rows, []) == [] and search(spark, [], rows) == []
