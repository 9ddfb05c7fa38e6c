from __future__ import annotations

import re
from collections import Counter

import pytest

from tabforge.llm.mixing import mix, plan_mix
from tests.llm.data import awkward_rows, documents, sentence


def water_fill(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2.0) -> dict:
    """The contract's words, step by step: cap what is above, share the rest again by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {}, share * sum(sizes.values()), set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in above)
        open_ -= above
    return target


@pytest.mark.parametrize("rows", [awkward_rows(), [(i, sentence(i, 1 + i % 50), "abcdefg"[i * i % 7]) for i in range(400)]])
def test_targets_and_copies(spark, rows):
    found = plan_mix(documents(spark, rows)).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += words(text)
    expected = water_fill(sizes)
    assert len(found) == len(rows)
    for r in found:
        assert r["size"] == words(r["text"])
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert 0 <= r["copies"] <= 2
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["copies"] in (int(rate), int(rate) + 1)


def test_taken_words_come_near_the_targets(spark):
    rows = [(i, sentence(i, 20), "hot" if i % 3 else f"s{i % 9}") for i in range(3000)]
    planned = plan_mix(documents(spark, rows))
    per_source = planned.selectExpr("source", "target", "copies * size AS taken").groupBy("source", "target").sum("taken").collect()
    for r in per_source:
        assert abs(r["sum(taken)"] / r["target"] - 1) < 0.15


def test_emission_reruns_and_clashing_names(spark):
    docs = documents(spark, awkward_rows()).selectExpr("*", "'x' AS size", "1 AS COPIES", "2 AS copy_no")
    one, two = (sorted(map(str, mix(docs.drop("size", "COPIES")).collect())) for _ in range(2))
    assert one == two
    planned = plan_mix(docs)
    assert [c for c in planned.columns if c.lower() == "copies"] == ["copies"]
    emitted = mix(docs)
    assert "copy_no" in emitted.columns
    assert emitted.count() == planned.selectExpr("sum(copies)").first()[0]


def test_empty_table(spark):
    assert mix(documents(spark, [])).count() == 0
    assert plan_mix(documents(spark, [(1, None), (2, "")])).selectExpr("sum(copies)").first()[0] == 0
