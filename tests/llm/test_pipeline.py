from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

import corpus_pipeline as cp
from tests.llm.data import awkward_rows, documents, sentence
from tests.llm.test_near_dedup import brute_force, shingles


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng, folder = random.Random(1), tmp_path_factory.mktemp("sf")
    rows = [(i, sentence(i, rng.randint(6, 60)) + (" grumph snarkle" if i % 4 == 0 else ""), f"s{i % 4}") for i in range(100, 400)]
    rows += [(1000 + i, sentence(9, 80) + (f" x{i}" if i % 2 else ""), "s0") for i in range(40)]
    rows += [(2000, "mail token = abcdefgh12345 and password: hunter2hunter2 end of the text here", "s1")]
    documents(spark, rows + awkward_rows()).selectExpr("*", "1 AS score", "2 AS spans", "3 AS size").write.parquet(str(folder / "documents.parquet"))
    labels = [(i, int(i % 4 == 0)) for i in range(100, 400) if i % 3]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder)


def test_stages_one_after_the_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, texts = docs.columns, {}
    for name, stage in cp.STAGES:
        before, docs = docs, cp.materialize(stage(spark, docs, sf_dir), "test-stage")
        if name == "toxicity":
            left = {r["doc_id"] for r in docs.collect()}
            assert not [i for i in left if i is not None and 100 <= i < 400 and i % 4 == 0]
            assert len([i for i in range(100, 400) if i % 4 and i in left]) == 225  # clean documents stay
        if name == "near_dedup":
            expected = brute_force([(r["doc_id"], r["text"]) for r in before.collect()])
            kept = [r["doc_id"] for r in docs.collect()]
            assert sorted(i for i in kept if i is not None) == sorted(i for i, (_, root) in expected.items() if i == root)
            assert kept.count(None) == 1
        if name == "secrets":
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert docs.count() == before.count()
            assert texts[2000] == "mail [SECRET] and [SECRET] end of the text here"
            assert {r["n_chars"] for r in docs.where("doc_id = 2000").collect()} == {len(texts[2000])}
        if name == "mixing":
            assert {r["doc_id"] for r in docs.collect()} <= texts.keys() and max(docs.groupBy("doc_id").count().toPandas()["count"]) <= 2
        if name != "sentencepiece":
            assert docs.columns == columns
    truth = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in docs.collect():
        assert r["parity"] and r["ids"] == truth.encode(texts[r["doc_id"]] or "") and r["n_tokens"] == len(r["ids"])


def test_run_is_the_stages_and_repeats(spark, sf_dir):
    one, two = (sorted(map(str, cp.run(spark, sf_dir).collect())) for _ in range(2))
    assert one == two and one
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "secrets", "mixing", "sentencepiece"]


def test_near_copies_at_four_fifths_are_dropped(spark):
    """Pairs of 0.82, which the stage merges, and of 0.78, which stay."""
    rows = []
    for i in range(40):
        words = sentence(500 + i, 95).split()
        words = [f"{w}{j}" for j, w in enumerate(words)]  # 91 shingles; a changed end of n words loses n of them
        rows += [(10 * i, " ".join(words)), (10 * i + 1, " ".join(words[: -9 if i % 2 == 0 else -11] + [f"x{i}y{j}" for j in range(9 if i % 2 == 0 else 11)]))]
    for i, j in ((0, 1), (2, 3)):
        a, b = shingles(rows[i][1]), shingles(rows[j][1])
        assert round(len(a & b) / len(a | b), 2) == (0.82 if i == 0 else 0.78)
    left = {r["doc_id"] for r in cp.drop_near_copies(spark, documents(spark, rows), "").collect()}
    assert left == {i for i, _ in rows if i % 20 != 1}


def test_python_gets_few_documents_at_once(spark, tmp_path, monkeypatch):
    """A batch is held by the JVM and by the worker of every task."""

    def sizes(session, docs, sf_dir):
        def count(batches):
            yield from (b.slice(0, 1).select([]).append_column("rows", pa.array([b.num_rows], pa.int64())) for b in batches)

        return docs.coalesce(1).mapInArrow(count, "rows long")

    documents(spark, [(i, "a b") for i in range(100)]).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(cp, "STAGES", [("sizes", sizes)])
    monkeypatch.setattr(cp, "BATCH_ROWS", 30)
    found = [r["rows"] for r in cp.run(spark, str(tmp_path)).collect()]
    assert sum(found) == 100 and max(found) <= 30
