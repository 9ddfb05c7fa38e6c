"""Small column helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space of the contracts is the blank and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    """Words of the whole text; 0 for null and for texts of white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unused(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` does not have (Spark compares them without case)."""
    taken, names = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Quoted columns of ``df`` but for ``names``, which an operator is going to add itself."""
    drop = {n.lower() for n in names}
    return [f"`{c.replace('`', '``')}`" for c in df.columns if c.lower() not in drop]


def hash_unit(seed: int, *keys: str | Column) -> Column:
    """A number in [0, 1) from md5 of the seed and the keys (null: the word null); the same in any engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string") if isinstance(k, str) else k.cast("string"), F.lit("null")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def sliced(batches: Iterator, rows: int = 500) -> Iterator:
    """The same rows in small batches, as what is made of them in Python is much larger than they are."""
    for batch in batches:
        for i in range(0, len(batch), rows):
            yield batch.slice(i, rows)
