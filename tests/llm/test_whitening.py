from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabforge.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>, n string"


def brute_force(rows: list[tuple], components: int, scale: int) -> dict:
    """Per id the deviation and the whitened values up to sign, by numpy on all rows of one dimension."""
    kept = [(i, tuple(math.floor(scale * c) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in kept}), float)
    n, sums = len(fit), [sum(c) for c in zip(*{x for _, x in kept}, strict=True)]
    centred = fit - fit.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return {
        i: (n, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)), np.abs((np.array(x) - fit.mean(0)) @ vectors / np.sqrt(values)), values / (centred**2).sum() * n)
        for i, x in kept
    }


def whitened(spark, rows, **options) -> list:
    return wh.whiten(spark.createDataFrame(rows, SCHEMA).repartition(4), **options).collect()


def vectors(n: int, d: int, seed: int, offset: float = 0.0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.linspace(0.3, 2, d)
    return [(i, (rng.normal(size=d) @ mix + offset).tolist(), "x") for i in range(n)]


@pytest.mark.parametrize(("n", "d", "offset"), [(300, 6, 0.0), (250, 64, 0.0), (120, 5, 1e9), (50, 2, -3.0), (40, 1, 0.0)])
def test_equals_plain_eigenvectors(spark, n, d, offset):
    rows = vectors(n, d, n, offset)
    rows += rows[:30]
    expected = brute_force([r[:2] for r in rows], 4, 256)
    found = whitened(spark, rows)
    assert len(found) == len(rows) * min(4, d)
    for r in found:
        n_, deviation, white, explained = expected[r["vec_id"]]
        assert (r["n"], r["deviation"]) == (n_, deviation)
        assert abs(r["whitened"]) == pytest.approx(white[r["component"] - 1], abs=1e-6)
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-6)
        assert r["identity_error"] < 1e-8


def test_signs_agree_and_reruns_agree(spark):
    rows = vectors(200, 6, 9)
    one, two = (sorted((r["vec_id"], r["component"], r["whitened"]) for r in whitened(spark, rows)) for _ in range(2))
    assert [o[:2] for o in one] == [t[:2] for t in two]
    assert np.allclose([o[2] for o in one], [t[2] for t in two], atol=1e-9)
    table = np.array([o[2] for o in one]).reshape(200, 4)
    assert np.abs(np.cov(table.T, bias=True) - np.eye(4)).max() < 1e-9


def test_degenerate_tables(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None, None), (2, [], ""), (3, [None], ""), (4, [float("inf")], "")]) == []
    same = whitened(spark, [(1, [0.5, 1.0], ""), (2, [0.5, 1.0], ""), (None, [0.5, 1.0], "")])
    assert len(same) == 6 and {(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in same} == {(1, 0, 0.0, 0.0)}
    line = whitened(spark, [(i, [float(i), 2.0 * i, 0.0], "") for i in range(10)])
    assert {r["whitened"] for r in line if r["component"] > 1} == {0.0}
    assert {round(r["explained"], 12) for r in line if r["component"] == 1} == {1.0}


def test_each_dimension_has_its_own_fit(spark):
    some, other = vectors(60, 3, 1), [(1000 + i, v, n) for i, v, n in vectors(80, 5, 2)]
    found = whitened(spark, some + other)
    alone = {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in whitened(spark, some)}
    mixed = {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in found if r["vec_id"] < 1000}
    assert mixed == pytest.approx(alone, abs=1e-9) and {r["n"] for r in found} == {60, 80}


def test_large_numbers_do_not_overflow_silently(spark):
    rows = [(i, [1e300 if i % 2 else -1e300, float(i)], "") for i in range(6)]
    found = whitened(spark, rows)
    assert len(found) == 12 and all(r["deviation"] is None for r in found) and all(math.isfinite(r["whitened"]) for r in found)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_components_of_clustered_spectra(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 12))
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    spectrum = rng.choice([0.0, 1.0, 1.0 + 1e-13, 1.0 + 1e-6, 5.0, 5.0, 100.0], d)
    c = (q * spectrum) @ q.T
    c = (c + c.T) / 2
    values, v = wh.leading_components(c, 4)
    assert np.allclose(values, np.linalg.eigvalsh(c)[::-1][: len(values)], atol=1e-12 * max(1, spectrum.max()))
    assert np.abs(v.T @ v - np.eye(len(values))).max() < 1e-12
    assert np.abs(c @ v - v * values).max() < 1e-11 * max(1, spectrum.max())


def test_tridiagonal_form_and_counts():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(9, 9))
    a = a + a.T
    diagonal, off, q = wh.tridiagonal(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.allclose(q @ t @ q.T, a) and np.allclose(q @ q.T, np.eye(9))
    values = np.linalg.eigvalsh(a)
    assert wh.sturm_counts(diagonal, off, (values[:-1] + values[1:]) / 2).tolist() == list(range(1, 9))
