from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators.digests import compare_tables, table_digest


def table(spark):
    i = F.col("id")
    return spark.range(500).select("id", (i % 7).cast("string").alias("s"), F.when(i % 5 > 0, i / 3).alias("x"), F.array(i, i + 1).alias("list"))


def same(a, b):
    return {r["column"]: r["same"] for r in compare_tables(a, b).collect()}


def test_order_and_partitions_do_not_matter(spark):
    df = table(spark)
    assert all(same(df, df.orderBy(F.desc("id")).repartition(7)).values())
    assert set(same(df, df)) == {"id", "s", "x", "list", "row"}


def test_a_changed_and_a_repeated_row_are_found(spark):
    df = table(spark)
    changed = df.withColumn("s", F.when(F.col("id") == 3, "other").otherwise(F.col("s")))
    assert same(df, changed) == {"id": True, "s": False, "x": True, "list": True, "row": False}
    assert not any(same(df, df.union(df.limit(1))).values())
    twice = df.where("id <> 4").union(df.where("id = 5"))
    assert not same(df, twice)["row"]
    swapped = df.withColumn("s", F.when(F.col("id") == 0, "1").when(F.col("id") == 1, "0").otherwise(F.col("s")))
    assert same(df, swapped) == {"id": True, "s": True, "x": True, "list": True, "row": False}


def test_nulls_groups_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("b", "-"), (None, None)], "g string, v string")
    lines = table_digest(df, ["v"], ["g"], portable=True).where("column = 'v'").collect()
    assert {r["g"]: r["rows"] for r in lines} == {"a": 2, "b": 1, None: 1}
    assert len({(r["total"], r["parity"]) for r in lines}) == 3
    empty = df.where("false")
    assert table_digest(empty).collect() == []
    assert not any(same(df, empty).values()) and same(empty, empty) == {}
