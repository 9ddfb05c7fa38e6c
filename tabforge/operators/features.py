"""Leakage-safe feature building: split, encodings, scaling, and the fitted model of all of them."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tabforge.functions.hashing import bucket
from tabforge.functions.numeric import half_even, not_nan
from tabforge.operators.cleaning import drop_columns
from tabforge.operators.lookups import lookup_default
from tabforge.operators.quantiles import column_stats
from tabforge.session import materialize

WIDE_CAP = 10_000  # values of a column that may become columns of their own


@dataclass(frozen=True)
class FeatureConfig:
    """Column roles. ``vocabulary`` is learned on the ``full`` table or on ``train`` only."""

    target: str
    categorical: tuple[str, ...]
    numerical: tuple[str, ...]
    split_key: str
    redundant: tuple[str, ...] = ()
    interaction: tuple[str, str, str] | None = ("source", "destination", "route")
    target_encode: tuple[str, ...] = ()
    log_target: bool = False
    log_numeric: tuple[str, ...] = ()
    val_share: float = 0.1
    test_share: float = 0.2
    seed: int = 42
    vocabulary: str = "full"
    cap: int = WIDE_CAP

    @property
    def one_hot(self) -> tuple[str, ...]:
        extra = (self.interaction[2],) if self.interaction else ()
        return tuple(dict.fromkeys(c for c in self.categorical + extra if c not in self.target_encode))


# --- single steps ---------------------------------------------------------


def interaction(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``a_b``; missing if either side is, and no change if either column is absent."""
    if a not in df.columns or b not in df.columns:
        return df
    return df.withColumn(out, F.concat(F.col(a), F.lit("_"), F.col(b)))


def split_column(key: str | Column, val: float = 0.1, test: float = 0.2, seed: int = 42) -> Column:
    """train / val / test from a hash of the row key: shares are approximate, rows never move."""
    train, upto = round(1000 * (1 - val - test)), round(1000 * (1 - test))
    b = bucket(key, seed)
    return F.when(b < train, "train").when(b < upto, "val").otherwise("test")


def exact_split(df: DataFrame, key: str, val: float = 0.1, test: float = 0.2, seed: int = 42) -> DataFrame:
    """Splits of exact size for a unique key: cuts the key's hashes at two exact order statistics."""
    hashed = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 12).cast("double")
    rows = df.withColumn("_h", hashed)
    n = rows.count()
    if n < 2:
        return rows.withColumn("split", F.lit("train")).drop("_h")
    n_test = math.ceil(n * test)
    n_val = math.ceil((n - n_test) * (val / (1.0 - test)))
    cuts = column_stats(
        rows, ["_h"], {"t": (n_test - 0.5) / (n - 1), "v": (n_test + n_val - 0.5) / (n - 1)}, ()
    ).first()
    return rows.withColumn(
        "split", F.when(F.col("_h") < cuts["t"], "test").when(F.col("_h") < cuts["v"], "val").otherwise("train")
    ).drop("_h")


def log_numeric(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """``log1p`` with negative values clipped to 0."""
    present = [c for c in columns if c in df.columns]
    clipped = {c: F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))) for c in present}
    # greatest skips NULLs, so a missing value is put back
    return df.withColumns({c: F.when(F.col(c).isNotNull(), v) for c, v in clipped.items()})


@dataclass
class Vocabulary:
    """Distinct values per column as a stored table ``(value, index, column)``; the driver knows only their numbers.

    The index of a value counts from 0 in the order of the column's values.
    """

    table: DataFrame
    sizes: dict[str, int]

    def words(self, cap: int = WIDE_CAP) -> dict[str, list[str]]:
        """The values by column, for named columns; a column with more than ``cap`` of them raises before any is collected."""
        large = {c: n for c, n in self.sizes.items() if n > cap}
        if large:
            raise ValueError(f"too many values for a column each (cap {cap}): {large}; use the vector form or target-encode them")
        out: dict[str, list[str]] = {c: [] for c in self.sizes}
        for r in self.table.orderBy("column", "index").collect():
            out[r["column"]].append(r["value"])
        return out


def vocabulary(df: DataFrame, columns: list[str] | tuple[str, ...]) -> Vocabulary | None:
    """The distinct values of the columns that exist, from one scan; None without any.

    The values are sorted into ranges and numbered within them; only the number
    of values per range goes through a running sum.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return None
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in present]).unpivot([], present, "column", "value")
    seen = materialize(long.where(F.col("value").isNotNull()).distinct(), "vocabulary-values")
    ranged = seen.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    placed = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)), "vocabulary-order")
    ranges = placed.groupBy("column", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    below = "coalesce(sum(_n) OVER (PARTITION BY column ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    ranges = materialize(ranges.selectExpr("column", "_range", "_first", "_n", f"{below} AS _below"), "vocabulary-ranges")
    index = (F.col("_at") - F.col("_first") + F.col("_below")).cast("int").alias("index")
    table = materialize(placed.join(ranges, ["column", "_range"]).select("value", index, "column"), "vocabulary", ["column"])
    sizes = {r["column"]: int(r["n"]) for r in ranges.groupBy("column").agg(F.sum("_n").alias("n")).collect()}
    return Vocabulary(table, {c: sizes.get(c, 0) for c in present})


def one_hot_columns(words: dict[str, list[str]], drop_first: bool = False) -> dict[str, Column]:
    """0/1 column per known value; missing and unknown values are 0 everywhere."""
    out = {}
    for c, values in words.items():
        for v in values[1 if drop_first else 0 :]:
            out[f"{c}_{v}"] = F.coalesce((F.col(f"`{c}`").cast("string") == v).cast("int"), F.lit(0))
    return out


def one_hot_wide(
    df: DataFrame, columns: list[str] | tuple[str, ...], target: str | None = None, drop_first: bool = False
) -> DataFrame:
    """Indicator columns in place of the categories; features sorted by name, target last."""
    found = vocabulary(df, columns)
    words = found.words() if found else {}
    indicators = one_hot_columns(words, drop_first)
    plain = {c: F.col(f"`{c}`") for c in df.columns if c not in words and c != target}
    merged = {**plain, **indicators}
    last = [target] if target and target in df.columns else []
    return df.select(*[merged[c].alias(c) for c in sorted(merged)], *last)


def target_means(train: DataFrame, column: str, label: str) -> tuple[DataFrame, float | None]:
    """Mean label per category of the training rows as a stored lookup table, and the mean over all of them."""
    groups = train.groupBy(column).agg(F.avg(label).alias("mean"), F.sum(label).alias("_sum"), F.count(label).alias("_n"))
    stored = materialize(groups, "target-means")
    overall = stored.agg(F.try_divide(F.sum("_sum"), F.sum("_n").cast("double"))).first()[0]
    return stored.where(F.col(column).isNotNull() & (F.col("_n") > 0)).select(column, "mean"), overall


def scaler_state(train: DataFrame, columns: list[str] | tuple[str, ...]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column; a constant column is divided by 1."""
    present = [c for c in columns if c in train.columns]
    if not present:
        return {}
    aggs = [f(not_nan(c)).alias(f"{n}_{c}") for c in present for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = train.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in present if row[f"m_{c}"] is not None}


def standardize(df: DataFrame, state: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in state.items() if c in df.columns}
    )


def split_features_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    if target not in df.columns:
        raise KeyError(f"target column {target!r} not found")
    return df.drop(target), df.select(target)


def sparse_vectors(size: int):
    """A function of indices and values (arrays) that gives sparse vectors of ``size``, a batch at a time."""

    @F.arrow_udf(VectorUDT())
    def vectors(indices: pa.Array, values: pa.Array) -> pa.Array:
        n = len(indices)
        parts = [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), indices, values]
        return pa.StructArray.from_arrays(parts, names=["type", "size", "indices", "values"])

    return vectors


def vector_schema(parts: DataFrame) -> StructType:
    """The schema of ``parts`` with vectors as ``features``: Spark stores a vector as the struct of its parts."""
    return StructType([StructField(f.name, VectorUDT() if f.name == "features" else f.dataType) for f in parts.schema])


# --- the fitted flow ------------------------------------------------------


@dataclass
class FeatureModel:
    """Everything learned from the training rows; applies the same steps to any table or stream."""

    config: FeatureConfig
    vocabulary: Vocabulary | None
    scaler: dict[str, tuple[float, float]]
    global_mean: float | None
    lookups: dict[str, DataFrame] = field(default_factory=dict)

    @cached_property
    def words(self) -> dict[str, list[str]]:
        """Values by one-hot column, where names are asked for."""
        return self.vocabulary.words(self.config.cap) if self.vocabulary else {}

    @property
    def one_hot_names(self) -> list[str]:
        return [f"{c}_{v}" for c, values in self.words.items() for v in values]

    @property
    def numeric_names(self) -> list[str]:
        encoded = [f"{c}_te" for c in self.lookups]
        return [*self.scaler, *encoded]

    @property
    def feature_names(self) -> list[str]:
        return [*self.one_hot_names, *self.numeric_names]

    def _numbers(self, df: DataFrame) -> DataFrame:
        cfg = self.config
        out = drop_columns(df, cfg.redundant)
        if cfg.interaction:
            out = interaction(out, *cfg.interaction)
        out = log_numeric(out, cfg.log_numeric)
        for column, table in self.lookups.items():
            out = lookup_default(out, table, column, "mean", F.lit(self.global_mean), f"{column}_te").drop(column)
        return standardize(out, self.scaler)

    def transform_wide(self, df: DataFrame) -> DataFrame:
        """Named feature columns sorted by name, after the columns that are not features."""
        out = self._numbers(df)
        indicators = one_hot_columns(self.words)
        numbers = {c: F.col(c) for c in self.numeric_names}
        merged = {**numbers, **indicators}
        rest = [c for c in out.columns if c not in merged and c not in self.words]
        return out.select(*rest, *[merged[c].alias(c) for c in sorted(merged)])

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``features``: sparse one-hot blocks, then the scaled numbers (order of ``feature_names``).

        The index of a value comes from a join with its column's vocabulary, so
        no value passes the driver; missing and unknown values are 0 everywhere.
        """
        out, kept, size, indices, values = self._sparse(df)
        return out.select(*kept, sparse_vectors(size)(indices, values).alias("features"))

    def transform_parts(self, df: DataFrame) -> DataFrame:
        """``transform`` with ``features`` as the parts of its vectors, made without Python.

        Stored and read back with ``vector_schema``, they are vectors. A missing
        number raises, as a vector cannot hold one.
        """
        out, kept, size, indices, values = self._sparse(df)
        known = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in self.numeric_names], F.lit(True))
        values = F.when(known, values).otherwise(F.raise_error(F.lit("a feature is missing")).cast("array<double>"))
        parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
        return out.select(*kept, parts.alias("features"))

    def _sparse(self, df: DataFrame) -> tuple[DataFrame, list[Column], int, Column, Column]:
        """The rows, the columns they keep, and size, indices and values of their vectors."""
        out, start, hot = self._numbers(df), 0, []
        kept = out.columns
        for i, (c, size) in enumerate((self.vocabulary.sizes if self.vocabulary else {}).items()):
            values = self.vocabulary.table.where(F.col("column") == c).select(F.col("value").alias(f"_value{i}"), (F.col("index") + start).alias(f"_place{i}"))
            out = out.join(values, F.col(f"`{c}`").cast("string") == F.col(f"_value{i}"), "left").drop(f"_value{i}")
            hot.append(F.col(f"_place{i}"))
            start += size
        numbers = [F.col(f"`{c}`").cast("double") for c in self.numeric_names]
        full = F.array(*hot)
        every = reduce(lambda a, b: a & b, [c.isNotNull() for c in hot], F.lit(True))
        places = F.when(every, full).otherwise(F.array_compact(full)) if hot else F.array().cast("array<int>")
        indices = F.concat(places, F.array(*[F.lit(start + i) for i in range(len(numbers))]).cast("array<int>"))
        values = F.concat(F.array_repeat(F.lit(1.0), F.size(places)), F.array(*numbers).cast("array<double>"))
        return out, [F.col(f"`{c}`") for c in kept], start + len(numbers), indices, values

    def scaler_table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, m, s) for c, (m, s) in self.scaler.items()]
        table = spark.createDataFrame(rows, "feature string, mean double, scale double")
        return table.select("feature", half_even("mean", 4).alias("mean"), half_even("scale", 4).alias("scale"))

    def save(self, spark: SparkSession, path: str) -> None:
        state = {
            "config": asdict(self.config),
            "sizes": self.vocabulary.sizes if self.vocabulary else None,
            "scaler": self.scaler,
            "global_mean": self.global_mean,
            "lookups": list(self.lookups),
        }
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/state"
        )
        for column, table in self.lookups.items():
            table.write.mode("overwrite").parquet(f"{path}/lookup-{column}")
        if self.vocabulary:
            self.vocabulary.table.write.mode("overwrite").partitionBy("column").parquet(f"{path}/vocabulary")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        state = json.loads(spark.read.text(f"{path}/state").first()["value"])
        cfg = {k: tuple(v) if isinstance(v, list) else v for k, v in state["config"].items()}
        table = spark.read.schema("value string, index int, column string").parquet(f"{path}/vocabulary") if state["sizes"] is not None else None
        return cls(
            FeatureConfig(**cfg),
            Vocabulary(table, state["sizes"]) if table is not None else None,
            {c: tuple(v) for c, v in state["scaler"].items()},
            state["global_mean"],
            {c: spark.read.parquet(f"{path}/lookup-{c}") for c in state["lookups"]},
        )


def labelled(df: DataFrame, config: FeatureConfig) -> DataFrame:
    """Adds ``split`` and ``label`` (``log1p`` of the target when configured)."""
    if config.target not in df.columns:
        raise KeyError(f"target column {config.target!r} not found")
    y = F.col(config.target).cast("double")
    split = split_column(config.split_key, config.val_share, config.test_share, config.seed)
    return df.withColumns({"split": split, "label": F.log1p(y) if config.log_target else y})


def fit_features(df: DataFrame, config: FeatureConfig) -> FeatureModel:
    """Learns vocabulary, target means and scaling; everything but the vocabulary from training rows only."""
    rows = drop_columns(labelled(df, config), config.redundant)
    if config.interaction:
        rows = interaction(rows, *config.interaction)
    train = rows.where(F.col("split") == "train")
    values = vocabulary(train if config.vocabulary == "train" else rows, config.one_hot)
    learned = {c: target_means(train, c, "label") for c in config.target_encode if c in rows.columns}
    lookups = {c: table for c, (table, _) in learned.items()}
    mean = next((m for _, m in learned.values()), None)
    scaler = scaler_state(log_numeric(train, config.log_numeric), config.numerical)
    return FeatureModel(config, values, scaler, mean, lookups)


def feature_set(df: DataFrame, model: FeatureModel, keys: tuple[str, ...] = ()) -> DataFrame:
    """``keys``, split, label and the named feature columns of every row."""
    rows = model.transform_wide(labelled(df, model.config))
    return rows.select(*keys, "split", "label", *[f"`{c}`" for c in sorted(model.feature_names)])


def split_report(rows: DataFrame, label: str = "label") -> DataFrame:
    """Size, share and label range of each split."""
    from tabforge.functions.numeric import percent
    from tabforge.operators.quantiles import group_stats

    def all_rows(groups: DataFrame) -> Column:
        return groups.agg(F.sum("count")).scalar()

    stats = group_stats(rows, ["split"], label, {"median": 0.5}, ("min", "max"), scalars={"_all": all_rows})
    return stats.select(
        "split",
        F.col("count").alias("rows"),
        half_even(percent(F.col("count"), F.col("_all")), 2).alias("share_pct"),
        *[half_even(c, 4).alias(c) for c in ("min", "median", "max")],
    )
