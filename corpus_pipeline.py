"""A training corpus from raw documents: five stages, each by one operator of ``tabforge.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the next stage's documents. ``run`` applies them to the documents table
and hands each result over as Parquet in the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import mixing, near_dedup, secret_scan, sentencepiece_tokens, toxicity
from tabforge.session import materialize, setting

def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The whole row as one column, ``document``, next to what an operator needs, so that no extra column meets one of its names."""
    return docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("document"), *needed)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not mark (score below 0.3), learned from the labels of these documents."""
    slim = packed(docs, "doc_id", "text")
    model = toxicity.fit_toxicity(slim, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_toxicity(slim, model).where("predicted = 0").select("document.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; texts without words all stay.

    Near copies share four fifths of their five-word shingles; the bands miss a
    pair of that similarity with probability 2.3e-7.
    Rows that share a kept id are repeats of one document: one of them stays,
    the same one in every run. Rows without an id cannot be named and all stay.
    """
    found = near_dedup.near_duplicates(docs.select("doc_id", "text"), percent=80, bands=29, rows=4)
    kept = found.where("kept AND doc_id IS NOT NULL")
    kept = materialize(kept.select(F.col("doc_id").alias("kept_id")).distinct(), "kept-ids")
    rows = packed(docs, "doc_id")
    named = rows.join(kept, F.col("doc_id") == F.col("kept_id"), "left_semi")
    named = named.groupBy("doc_id").agg(F.min_by("document", F.xxhash64("document")).alias("document"))
    return named.select("document.*").union(docs.where("doc_id IS NULL"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark; ``n_chars`` follows where a text changes."""
    found = secret_scan.scan_secrets(packed(docs, "text"), carried=["document"])
    masked = secret_scan.redacted(F.col("document.text"), "spans")
    changed = F.size("spans") > 0
    columns = {
        "text": F.when(changed, masked).otherwise(F.col("document.text")),
        "n_chars": F.when(changed, F.char_length(masked).cast("long")).otherwise(F.col("document.n_chars")),
    }
    return found.select(*[columns.get(c, F.col(f"document.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixing.mix(packed(docs, "doc_id", "text", "source")).select("document.*")


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, the SentencePiece ids of the text, their number, and whether they are verified."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepiece_tokens.encode_documents(docs.select("doc_id", "lang", "source", "text"), model, keep_text=False)
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "parity")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", to_tokens),
]

# A learned classifier and a tokenizer model cannot be written in SQL.
ORACLE_SQL = None


BATCH_ROWS = 1000  # documents that go to Python at once; the JVM and the worker of each task hold them both


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS):
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
