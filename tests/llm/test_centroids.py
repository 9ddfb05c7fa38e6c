from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabforge.llm import centroids as ce
from tabforge.llm.queries import OP11_SQL, op11_centroid_clusters
from tests.oracle import compare

SCHEMA = "vec_id long, embedding array<float>, cluster string"


def plain_lloyd(rows: list[tuple], k: int, rounds: int, dim: int, scale: int, seed: int) -> list[tuple]:
    """(id, cluster, distance, sum over the cluster, over all, centroid) by comparing everything, in Python's integers."""
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        mine = [nearest(x)[1] for _, x in kept]
        for j in range(len(centres)):
            some = [x for (_, x), c in zip(kept, mine, strict=True) if c == j]
            if some:
                centres[j] = [sum(c) // len(some) for c in zip(*some, strict=True)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    total = {j: sum(f[2] for f in found if f[1] == j) for j in range(len(centres))}
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, total[c], sum(total.values()), text[c]) for i, c, d in found), key=str)


def grouped(n: int, dim: int, seed: int = 0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, dim)) * 3
    return [(i, (centre[i % 12] + rng.normal(size=dim) * (0.2 if i % 4 else 2)).tolist(), "x") for i in range(n)]


def result(spark, rows, **options):
    found = ce.cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5), **options)
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize(("dim", "k", "rounds", "scale"), [(6, 5, 3, 64), (2, 7, 6, 8), (1, 4, 3, 2), (64, 16, 3, 64)])
def test_equals_plain_rounds(spark, dim, k, rounds, scale):
    rows = grouped(400, dim, seed=dim)
    assert result(spark, rows, dim=dim, k=k, rounds=rounds, scale=scale) == plain_lloyd([r[:2] for r in rows], k, rounds, dim, scale, 1)


def test_ties_copies_nulls_and_vectors_that_take_no_part(spark):
    rows = [(i, [0.5, -0.5], None) for i in range(30)] + [(30, [0.5, -0.5], "x")] * 3 + [(None, [9.0, 9.0], "x"), (None, None, None)]
    rows += [(40, [1.0], ""), (41, [], ""), (42, [None, 1.0], ""), (43, [float("nan"), 1.0], ""), (44, [1.0, float("-inf")], ""), (45, [-0.01, 0.0], "")]
    expected = plain_lloyd([r[:2] for r in rows], 4, 3, 2, 64, 1)
    found = result(spark, rows, dim=2, k=4)
    assert found == expected and len(found) == 35 and len({f[1] for f in found}) <= 4
    few = result(spark, rows[-1:] + rows[33:34], dim=2, k=16)
    assert few == plain_lloyd([r[:2] for r in rows[-1:] + rows[33:34]], 16, 3, 2, 64, 1) and len(few) == 2
    assert result(spark, []) == [] and result(spark, rows[-1:]) == []


def test_large_components_are_cut_and_stay_exact(spark):
    rows = [(i, [3e38 if i % 2 else -3e38] * 64, None) for i in range(20)]
    found = result(spark, rows, k=3)
    assert len(found) == 20 and all(0 <= f[2] < 2**63 for f in found)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6))
def test_drift_bound_holds_and_is_below_the_full_drift(seed):
    rng = np.random.default_rng(seed)
    dim, k = int(rng.integers(1, 5)), 4
    old = rng.integers(-30, 30, (k, dim))
    new = old + rng.integers(-6, 7, (k, dim))
    radius = rng.uniform(0, 15, k)
    bounds = ce.drift_bounds(old, new, radius)
    assert (bounds <= np.linalg.norm(new - old, axis=1)[None, :] + 1e-12).all()
    for i in range(k):
        off = rng.normal(size=(200, dim))
        x = old[i] + off / np.linalg.norm(off, axis=1, keepdims=True) * radius[i] * rng.uniform(0, 1, (200, 1)) ** 0.2
        for j in range(k):
            fall = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
            assert fall.max() <= bounds[i, j] + 1e-9


def test_bounds_spare_most_scans_and_geometry_spares_more_than_full_drift(spark, monkeypatch):
    rows = spark.createDataFrame(grouped(3000, 8), SCHEMA)
    lattice = ce.lattice(rows, "vec_id", "embedding", 8, 64)
    scanned = ce.fit_clusters(lattice, 12, 3, 8, 1)[1].where("scanned").count()
    monkeypatch.setattr(ce, "drift_bounds", lambda old, new, radius: np.broadcast_to(np.sqrt(((new - old) ** 2).sum(1).astype(float)), (len(old), len(old))))
    plain = ce.fit_clusters(lattice, 12, 3, 8, 1)[1].where("scanned").count()
    assert scanned < plain and scanned < 1500


def test_query_equals_sql_on_awkward_vectors(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=64) * (1 + i % 3)).tolist(), "c") for i in range(200)] + [(7, [0.25] * 64, "c")] * 5
    rows += [(None, [0.5] * 64, None), (300, None, None), (301, [1.0] * 63, None), (302, [None] * 64, None), (303, [float("nan")] * 64, None)]
    spark.createDataFrame(rows, SCHEMA).withColumn("label", F.lit(1)).coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert compare(op11_centroid_clusters(spark, str(tmp_path)), con, OP11_SQL) == []
