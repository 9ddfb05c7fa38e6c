"""Small hand-made tables for the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(("ba", "ren", "to", "mil", "sa", "ku", "der")) for _ in range(rng.randint(1, 4))) for _ in range(n))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    full = [(i, t, "en", r[0] if r else "s", len(t) if t is not None else None) for i, t, *r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def awkward_rows() -> list[tuple]:
    """Nulls, empty and blank texts, a very long one, ties, repeated rows, odd characters."""
    long_text = sentence(7, 30_000)
    return [
        (1, None, None),
        (2, "", "b"),
        (3, " \t\n", "b"),
        (4, "one two three", "a"),
        (5, "one two three", "a"),
        (5, "one two three", "a"),
        (6, long_text, "a"),
        (7, long_text + " end", None),
        (None, "a row without an id and with some words", "c"),
        (8, "Ünï cödé 😀   and　space  double ▁mark▁ <s> <|endoftext|>", "c"),
        (9, sentence(1, 60), "d"),
        (10, sentence(1, 60) + " more", "d"),
    ]
