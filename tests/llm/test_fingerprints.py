from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from tabforge.llm import fingerprints as fp
from tests.llm.data import awkward_rows, documents, sentence


def sketch(text: str, k: int = 5, bound: str = "2000000000000000") -> list[str]:
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    parts = [words[i : i + k] for i in range(len(words) - k + 1)] if len(words) >= k else ([words] if words else [])
    hashes = {hashlib.md5(" ".join(p).encode()).hexdigest()[:16] for p in parts}
    below = sorted(h for h in hashes if h < bound)
    return below or sorted(hashes)[:1]


def alike(a: list, b: list) -> float:
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def check(spark, rows):
    found = sorted(fp.compare_with_edits(documents(spark, rows)).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["edited_sha256"]))
    texts = [t or "" for _, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    expected = []
    for i, text in enumerate(texts):
        after = texts[i - 1]
        third = len(text) // 3
        edit = text[: len(text) - third] + after[:third]
        a, b, c = sketch(text), sketch(edit), sketch(after)
        expected.append((len(text), hashlib.sha256(edit.encode()).hexdigest(), "".join(a), "".join(b), alike(a, b), alike(a, c)))
    keys = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted(tuple(r[k] for k in keys) for r in found) == sorted(expected)


def test_awkward_rows(spark):
    check(spark, awkward_rows())


def test_ranges_of_ids(spark):
    check(spark, [((i * 37) % 9001 - 4000, sentence(i % 50, 3 + i % 40)) for i in range(4500)])


def sizes(spark, ids, rows):
    docs = documents(spark, [(i, sentence(n, 3)) for n, i in enumerate(ids)]).withColumn("h", F.xxhash64("text"))
    placed = docs.withColumn("at", fp.id_ranges(docs, "doc_id", "h", rows)).select("doc_id", "h", "at").collect()
    in_order = sorted(placed, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]))
    assert [r["at"] for r in in_order] == sorted(r["at"] for r in placed)  # ranges ascend with the rows
    return sorted(Counter(r["at"] for r in placed).values())


def test_ranges_are_bounded_for_any_ids(spark, monkeypatch):
    """Far outliers, gaps, one id of a third of the rows and null ids leave no range much larger than asked for."""
    outlier = [*range(3000), 10**18, -(10**18)]
    crowded = [0] * 1500 + [None] * 1500 + list(range(1, 1500))
    for ids in (outlier, crowded, [2**60 + i for i in range(3000)], [None] * 3000):
        assert sizes(spark, ids, 100)[-1] <= 260
    monkeypatch.setattr(fp, "CUTS", 16)  # an outlier reaches one coarse range of 16
    assert sizes(spark, outlier, 20)[-1] <= 260 and sizes(spark, range(3000), 20)[-1] <= 60


def test_next_across_outliers_and_crowded_ids(spark, monkeypatch):
    rows = [(i, sentence(i, 12)) for i in range(300)] + [(10**18, "far above all"), (-(10**18), "far below all"), (None, "no id one"), (None, "no id two")]
    rows += [(7, sentence(1000 + i, 6)) for i in range(200)]
    docs = documents(spark, rows)
    for cuts in (4096, 4):
        monkeypatch.setattr(fp, "CUTS", cuts)
        found = fp.with_next(docs, {"id": F.col("doc_id"), "hash": F.xxhash64("text")}, rows=8).select("own", "next").collect()
        expected = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["h"]) for r in docs.select("doc_id", F.xxhash64("text").alias("h")).collect()), reverse=True)
        key = lambda s: (s["id"] is not None, s["id"] or 0, s["hash"])
        assert len(found) == len(rows)
        assert {(key(r["own"]), key(r["next"])) for r in found} == {(a, expected[(i + 1) % len(expected)]) for i, a in enumerate(expected)}


def test_empty_and_single(spark):
    assert fp.compare_with_edits(documents(spark, [])).count() == 0
    check(spark, [(5, "just one document with words")])
    check(spark, [(None, "a b"), (None, None)])


def test_merge_and_containment(spark):
    small, large = sentence(1, 400), sentence(1, 400) + " " + sentence(2, 8000)
    row = spark.createDataFrame([(small, large)], "a string, b string").select(
        fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"), fp.sketch(F.concat_ws(" ", "a", "b")).alias("both")
    )
    held, back, merged, both = row.select(
        fp.containment("a", "b"), fp.containment("b", "a"), fp.merged(F.col("a"), F.col("b")), "both"
    ).first()
    assert held == 1.0 and back < 0.1
    assert set(merged) <= set(both)


def test_no_python_in_the_plan(spark):
    plan = fp.compare_with_edits(documents(spark, awkward_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
