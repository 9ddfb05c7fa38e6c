"""Digests of tables that do not depend on the order of rows: equal tables are found without sorting or shuffling them.

A row and each of its values are hashed; the digest of a table is the number of
rows, and per column (and for the whole row) the sum and the xor of the hashes.
A repeated row changes the sum, so tables are compared as multisets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MODULUS = 2**52
ROW = "row"


def portable_hash(*values: Column) -> Column:
    """52 bits of the md5 of the values' texts, the same in any engine that writes them alike; a null differs from any text."""
    parts = [F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("-")) for v in values]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")


def native_hash(*values: Column) -> Column:
    """Spark's own 64-bit hash, which takes any type and is the faster one; a null counts as a value of its own."""
    return F.xxhash64(*values, *[v.isNull() for v in values])


def table_digest(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None, portable: bool = False) -> DataFrame:
    """``(by.., column, rows, total, parity)``: one line per column, and one for the whole row under the name ``row``.

    ``total`` is the sum of the hashes modulo 2^52, ``parity`` their xor. All
    partial sums are combined in the tasks. An empty table has no lines.
    """
    columns, by = columns or [c for c in df.columns if c not in (by or [])], by or []
    hash_of = portable_hash if portable else native_hash
    hashes = [hash_of(F.col(f"`{c}`")) for c in columns] + [hash_of(*[F.col(f"`{c}`") for c in columns])]
    slim = df.select(*by, *[h.alias(f"_h{i}") for i, h in enumerate(hashes)])
    sums = [F.pmod(F.sum(F.col(f"_h{i}").cast("decimal(38,0)")), F.lit(_MODULUS)).cast("long").alias(f"_t{i}") for i in range(len(hashes))]
    found = slim.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sums, *[F.bit_xor(f"_h{i}").alias(f"_x{i}") for i in range(len(hashes))])
    lines = [
        F.struct(F.lit(name).alias("column"), F.col("rows"), F.col(f"_t{i}").alias("total"), F.col(f"_x{i}").alias("parity"))
        for i, name in enumerate([*columns, ROW])
    ]
    return found.where("rows > 0").select(*by, F.explode(F.array(*lines)).alias("_line")).select(*by, "_line.*")


def compare_tables(a: DataFrame, b: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column, rows, other_rows, same)``: whether two tables hold the same values per column, and the same rows."""
    columns = columns or a.columns
    mine, other = table_digest(a, columns), table_digest(b, columns).withColumnsRenamed({"rows": "other_rows", "total": "_t", "parity": "_p"})
    same = (F.col("rows") == F.col("other_rows")) & (F.col("total") == F.col("_t")) & (F.col("parity") == F.col("_p"))
    numbers = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("rows", "other_rows")]
    return mine.join(other, "column", "full").select("column", *numbers, F.coalesce(same, F.lit(False)).alias("same"))
