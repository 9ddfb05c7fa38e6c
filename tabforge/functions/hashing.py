"""Deterministic pseudo-random buckets from a row key.

Buckets depend only on the key and the salt, so they are the same after any
repartitioning, retry or change of cluster size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabforge.functions.numeric import col


def bucket(key: Column | str, salt: str | int, buckets: int = 1000) -> Column:
    digest = F.md5(F.concat(col(key).cast("string"), F.lit(f":{salt}")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def digest_of_row(columns: list[str], salt: str | int) -> Column:
    """md5 over every listed column; NULL and empty text hash differently."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(salt))))
