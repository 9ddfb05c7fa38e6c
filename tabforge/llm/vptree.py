"""Nearest neighbours by cosine: vantage-point trees per shard, searched in blocks of queries.

On unit vectors the chord length sqrt(2 - 2 cos) is a metric that orders like
the cosine, so the triangle inequality bounds how near a subtree can be. A
subtree is left out when that bound exceeds ``relax`` times the distance of the
worst of the k found so far: 1 is exact, less prunes more.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import materialize

_SLACK = 1e-6  # the chord of almost equal vectors is only this exact


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All products of rows, each summed from the first component to the last: the same double on any machine and engine."""
    total = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T, strict=True):
        total += x[:, None] * y[None, :]
    return total


def lengths(a: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows, summed in the same order."""
    total = np.zeros(len(a))
    for x in a.T:
        total += x * x
    return np.sqrt(total)


class Tree:
    """Nodes as arrays: vantage vector, children (or -1), range of distances to the vantage point in each child, and rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = 64, seed: int = 0):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.repeats = np.array(len(np.unique(ids)) < len(ids))
        self.norms = lengths(self.vectors)
        unit = self.vectors / self.norms[:, None]
        rng, nodes, rows = np.random.default_rng(seed), [], []
        todo = [(np.arange(len(ids)), -1, 0)]
        while todo:
            some, parent, side = todo.pop()
            me = len(nodes)
            if parent >= 0:
                nodes[parent][1 + side] = me
            node = [-1, -1, -1, 0.0, 0.0, 0.0, 0.0, sum(map(len, rows)), 0]
            nodes.append(node)
            if len(some) > leaf:
                point = int(some[rng.integers(len(some))])
                far = np.sqrt(np.maximum(0, 2 - 2 * (unit[some] @ unit[point])))
                inner = far <= np.median(far)
                if not inner.all():
                    node[0] = point
                    node[3:7] = far[inner].min(), far[inner].max(), far[~inner].min(), far[~inner].max()
                    todo += [(some[inner], me, 0), (some[~inner], me, 1)]
            if node[0] < 0:
                rows.append(np.sort(some))
                node[8] = len(some)
        table = np.array(nodes, float)
        self.point, self.children = table[:, 0].astype(int), table[:, 1:3].astype(int)
        self.ranges, self.first, self.count = table[:, 3:7], table[:, 7].astype(int), table[:, 8].astype(int)
        self.rows = np.concatenate(rows) if rows else np.empty(0, int)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as arrays:
            tree.__dict__.update({k: arrays[k] for k in arrays.files})
        return tree

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines (-inf: none) of the k best different ids per query, best first, ties to the smaller id; the query's own id is left out.

        First every query goes down to the leaf on its side, which gives a
        distance to beat; then the tree is walked once for all queries, each
        leaving out the subtrees that its bound excludes.
        """
        norms = lengths(queries)
        unit, points = queries / norms[:, None], self.vectors / self.norms[:, None]
        best, score = np.full((len(queries), k), -1), np.full((len(queries), k), -np.inf)
        home = np.full(len(queries), -1)

        def scan(node: int, at: np.ndarray) -> None:
            rows = self.rows[self.first[node] : self.first[node] + self.count[node]]
            found = dots(queries[at], self.vectors[rows]) / (norms[at][:, None] * self.norms[rows][None, :])
            found[query_ids[at][:, None] == self.ids[rows][None, :]] = -np.inf
            ids = np.concatenate([best[at], np.broadcast_to(self.ids[rows], found.shape)], axis=1)
            both = np.concatenate([score[at], found], axis=1)
            if self.repeats:  # an id counts once, with its best score
                by_id = np.lexsort((-both, ids), axis=1)
                ids, both = np.take_along_axis(ids, by_id, 1), np.take_along_axis(both, by_id, 1)
                both[:, 1:][ids[:, 1:] == ids[:, :-1]] = -np.inf
            order = np.lexsort((ids, -both), axis=1)[:, :k]
            best[at], score[at] = np.take_along_axis(ids, order, 1), np.take_along_axis(both, order, 1)

        def away(node: int, at: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0, 2 - 2 * (unit[at] @ points[self.point[node]])))

        todo = [(0, np.arange(len(queries)))] if len(self.rows) else []
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if self.point[node] < 0:
                home[at] = node
                scan(node, at)
            else:
                far = away(node, at)
                inner = far <= (self.ranges[node, 1] + self.ranges[node, 2]) / 2
                todo += [(self.children[node, 0], at[inner]), (self.children[node, 1], at[~inner])]
        todo = [(0, np.arange(len(queries)))] if len(self.rows) else []
        while todo:
            node, at = todo.pop()
            if self.point[node] < 0:
                at = at[home[at] != node]
                if len(at):
                    scan(node, at)
                continue
            far = away(node, at)
            worst = np.where(score[at, -1] > -np.inf, np.sqrt(np.maximum(0, 2 - 2 * np.minimum(score[at, -1], 1))), np.inf)
            for side in (1, 0):
                low, high = self.ranges[node, 2 * side], self.ranges[node, 2 * side + 1]
                some = at[np.maximum(low - far, far - high) <= relax * worst + _SLACK]
                if len(some):
                    todo.append((self.children[node, side], some))
        return best, score


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, vector, dim)`` of what can take part: an id, and a vector of finite numbers that is not zero."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(v.isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return rows.withColumn("dim", F.size(v))


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = 4096, leaf: int = 64) -> DataFrame:
    """``(dim, shard, shards, tree)``: every vector in a tree of about ``shard_rows``, dealt by a hash of its id.

    Vectors are only comparable within a dimension, so each has shards of its
    own. A shard is of bounded size; trees are stored, so a search does not
    build them again.
    """
    rows = usable(vectors, id_col, vector_col)
    sizes = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    dealt = rows.join(materialize(sizes, "vp-sizes"), "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("shards")).cast("int"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(group["vec_id"].to_numpy(), np.stack(group["vector"].to_numpy()).astype(float), leaf)
        return pd.DataFrame({"dim": group["dim"].iloc[:1], "shard": group["shard"].iloc[:1], "shards": group["shards"].iloc[:1], "tree": [tree.to_bytes()]})

    trees = dealt.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, shards int, tree binary")
    return materialize(trees, "vp-index")


def search_index(
    index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, relax: float = 1.0, block: int = 512
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest of each query but itself, by cosine, ties to the smaller id.

    Queries are packed into blocks; each block meets each shard of its
    dimension once and keeps k per query, which are then merged in two steps so
    that no query gathers all shards at once. Queries that cannot take part and
    those without candidates have no rows; with fewer than k candidates all are
    returned. A query id that occurs more than once is searched with each of
    its vectors, and the best k different ids count.
    """
    rows = usable(queries, id_col, vector_col)
    blocks = max(1, math.ceil(rows.count() / block))
    packed = rows.groupBy("dim", F.pmod(F.xxhash64("vec_id", F.lit(6)), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("vec_id", "vector")).alias("queries")
    )
    shards = index.select("dim", "shards").distinct()
    tasks = packed.join(shards, "dim").select("dim", "queries", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    pairs = tasks.join(index.select("dim", "shard", "tree"), ["dim", "shard"]).select("shard", "queries", "tree")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, vectors = batch.column(1)[i].values.flatten()
                matrix = vectors.flatten().to_numpy().reshape(len(ids), -1)
                query_ids = ids.to_numpy()
                best, score = Tree.from_bytes(batch.column(2)[i].as_py()).search(query_ids, matrix, k, relax)
                row, at = np.nonzero(score > -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), batch.column(0)[i].as_py(), np.int32)),
                        pa.array(query_ids[row], pa.int64()),
                        pa.array(best[row, at], pa.int64()),
                        pa.array(score[row, at], pa.float64()),
                    ],
                    names=["shard", "query_id", "vec_id", "score"],
                )

    found = materialize(pairs.mapInArrow(search, "shard int, query_id long, vec_id long, score double"), "vp-found")
    once = found.groupBy("query_id", "vec_id", F.pmod("shard", F.lit(64)).alias("part")).agg(F.max("score").alias("score"))
    return nearest(nearest(once, k, "query_id", "part"), k, "query_id").select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, k: int, *keys: str | Column) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
