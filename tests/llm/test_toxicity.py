from __future__ import annotations

import random
import zlib

import pytest

from tabforge.llm import toxicity as tx
from tests.llm.data import awkward_rows, documents, sentence


def held_out(i: int) -> bool:
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def corpus():
    """Insults make a text toxic; one group is mentioned in toxic texts far more often than the others."""
    rng, rows, labels = random.Random(2), [], []
    for i in range(900):
        toxic = i % 3 == 0
        words = sentence(i, rng.randint(5, 80)).split()
        if toxic and rng.random() < 0.85:
            words.insert(rng.randrange(len(words)), rng.choice(("grumph", "blorgish", "snarkle")))
        group = "muslims" if rng.random() < (0.7 if toxic else 0.05) else rng.choice(("christians", "jews", "hindus"))
        words.insert(rng.randrange(len(words)), group)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def model_of(spark, corpus, **options):
    rows, labels = corpus
    return tx.fit_toxicity(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), **options)


def test_held_out_accuracy_and_contract(spark, corpus):
    rows, labels = corpus
    found = {r["doc_id"]: r for r in tx.score_toxicity(documents(spark, rows), model_of(spark, corpus)).collect()}
    truth = dict(labels)
    for i, r in found.items():
        assert r["held_out"] == held_out(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    out = [i for i in found if held_out(i)]
    insulted = [i for i in out if any(w in rows[i][1] for w in ("grumph", "blorgish", "snarkle"))]
    assert sum(found[i]["predicted"] for i in insulted) / len(insulted) > 0.9
    clean = [i for i in out if not truth[i]]
    assert sum(found[i]["predicted"] for i in clean) / len(clean) < 0.2


def test_swapped_groups_score_alike(spark, corpus):
    """The penalty takes away what the mention of a group adds; without it the group counts."""
    pairs = [(sentence(5000 + i, 12) + " muslims", sentence(5000 + i, 12) + " christians") for i in range(40)]

    def gap(model):
        score = model.scorer()
        return sum(abs(score(a) - score(b)) for a, b in pairs) / len(pairs)

    free, held = gap(model_of(spark, corpus, fairness=0.0)), gap(model_of(spark, corpus, fairness=100.0))
    assert held < 0.05 and held < free / 3


def test_same_model_in_every_run(spark, corpus):
    one, two = model_of(spark, corpus), model_of(spark, corpus)
    assert one == two


def test_awkward_rows_and_labels(spark):
    docs = documents(spark, awkward_rows()).selectExpr("*", "1 AS label", "2 AS SCORE", "3 AS label_id")
    labels = spark.createDataFrame([(4, 1), (9, 0), (9, 0), (6, None), (None, 1), (5, 3)], "doc_id long, toxic int")
    scored = tx.score_toxicity(docs, tx.fit_toxicity(docs, labels))
    assert scored.count() == len(awkward_rows())
    scores = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert scores[1] == scores[2] == scores[3] and 0 <= scores[1] <= 1
    assert tx.score_toxicity(documents(spark, []), tx.ToxicityModel(0.0)).count() == 0
    none = tx.fit_toxicity(docs, labels.where("toxic = 0"))
    assert {r["score"] < 1e-9 for r in tx.score_toxicity(docs, none).collect()} == {True}


def test_bounded_sample(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, toxic int")
    some = tx.training_labels(labels, "doc_id", "toxic", 500, 7)
    assert 400 < some.count() < 600 and not [r for r in some.collect() if held_out(r["label_id"])]
