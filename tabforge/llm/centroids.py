"""Centroid clustering of integer vectors, with bounds that loosen by geometric drift.

Every vector keeps an upper bound of the distance to its centroid and a lower
bound of that to each centroid. When the centroids move, a lower bound need not
fall by the whole drift: all vectors of a cluster lie in a sphere, and within
it the distance to a moved centroid can fall only as far as its position to the
line of the move allows (Rysavy and Hamerly, SDM 2016). Vectors whose bounds
leave one centroid keep it; the ambiguous ones are compared with all centroids
in exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import materialize

LARGEST = 2**27  # larger components are taken for this one, so that squared distances of 64 of them fit a long
_ROWS = "vec_id long, x array<int>"
_STATE = f"{_ROWS}, cluster int, upper double, lower array<float>, scanned boolean"


def lattice(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """``(vec_id, x)`` of the vectors with ``dim`` components, none null or non-finite; x is floor(scale * component)."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(v, lambda c: F.greatest(F.least(F.floor(c * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    return rows.where(v.isNotNull() & (F.size(v) == dim) & finite).select("vec_id", whole.alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:vec_id``, in that order; ties by the components, no id comes last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return np.array([r["x"] for r in rows.orderBy(order.asc_nulls_last(), "x").limit(k).collect()], np.int64)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to all centroids."""
    return (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)[None, :]


def drift_bounds(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """``[i, j]``: the most by which the distance to centroid j can fall for a vector in the sphere of cluster i.

    What comes nearer by 2a or more when a centroid moves from p to q lies
    inside a branch of the hyperbola with foci p and q, hence inside the cone
    of its asymptotes around the line of the move. The cone's half angle has
    the cosine 2a / |pq|, so the least angle under which the middle of pq sees
    a point of the sphere gives the bound. A sphere that holds the middle or
    touches the line ahead of it gives the whole drift; one behind the plane
    through the middle gives 0.
    """
    move = (new - old).astype(float)
    drift = np.sqrt((move * move).sum(1))
    away = old[:, None, :] - (old + new)[None, :, :] / 2
    far = np.sqrt((away * away).sum(2))
    with np.errstate(divide="ignore", invalid="ignore"):
        centre = np.arccos(np.clip(np.einsum("ijd,jd->ij", away, move) / (far * drift), -1, 1))
        angle = centre - np.arcsin(np.clip(radius[:, None] / far, 0, 1))
        nearer = drift * np.minimum(1, np.cos(np.clip(angle, 0, np.pi / 2)) + 1e-6)
    nearer = np.where(far <= radius[:, None] * (1 + 1e-9), drift, nearer)
    return np.where(drift == 0, 0.0, nearer)


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    """The vectors of a batch as a matrix, and their column."""
    column = batch.column("x")
    return column.flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.int64), column


def _state(batch: pa.RecordBatch, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, scanned: np.ndarray) -> pa.RecordBatch:
    starts = np.arange(0, lower.size + 1, max(1, lower.shape[1]), dtype=np.int32)
    down = np.nextafter(lower.astype(np.float32), np.float32(-np.inf))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("vec_id"),
            batch.column("x"),
            pa.array(cluster.astype(np.int32)),
            pa.array(upper),
            pa.ListArray.from_arrays(pa.array(starts), pa.array(down.ravel())),
            pa.array(scanned),
        ],
        names=["vec_id", "x", "cluster", "upper", "lower", "scanned"],
    )


def scan_all(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first assignment: all centroids are compared, so all bounds are distances."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, _ = _columns(batch)
                away = squared_distances(x, centroids)
                nearest = away.argmin(1)
                upper = np.sqrt(away[np.arange(len(x)), nearest])
                yield _state(batch, nearest, upper, np.sqrt(away), np.ones(len(x), bool))

    return scan


def reassign(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An assignment to moved centroids: bounds first, then the distance to the own centroid, then all of them."""
    loosen, own = drift_bounds(old, new, radius), np.sqrt(((new - old) ** 2).sum(1).astype(float))
    k = len(new)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, _ = _columns(batch)
            cluster = batch.column("cluster").to_numpy().astype(np.int64)
            lower = batch.column("lower").flatten().to_numpy().reshape(len(x), k).astype(float) - loosen[cluster]
            upper = batch.column("upper").to_numpy() + own[cluster]
            others = lower.copy()
            others[np.arange(len(x)), cluster] = np.inf
            nearest_other = others.min(1)
            unsure = np.flatnonzero(upper * (1 + 1e-9) + 1e-6 >= nearest_other)
            exact = x[unsure] - new[cluster[unsure]]
            upper[unsure] = np.sqrt((exact * exact).sum(1))
            unsure = unsure[upper[unsure] * (1 + 1e-9) + 1e-6 >= nearest_other[unsure]]
            away = squared_distances(x[unsure], new)
            cluster[unsure] = away.argmin(1)
            upper[unsure] = np.sqrt(away[np.arange(len(unsure)), cluster[unsure]])
            lower[unsure] = np.sqrt(away)
            scanned = np.zeros(len(x), bool)
            scanned[unsure] = True
            yield _state(batch, cluster, upper, lower, scanned)

    return step


def cluster_totals(state: DataFrame, k: int, dim: int) -> tuple[list[int], np.ndarray, list[list[int]]]:
    """Members, radius and component sums of each cluster; a task gives one row per cluster it has met."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, radius, sums = np.zeros(k, np.int64), np.zeros(k), np.zeros((k, dim), np.int64)
        for batch in batches:
            x, _ = _columns(batch)
            cluster = batch.column("cluster").to_numpy()
            for c in np.unique(cluster):
                mine = cluster == c
                count[c] += mine.sum()
                radius[c] = max(radius[c], batch.column("upper").to_numpy()[mine].max())
                sums[c] += x[mine].sum(0)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(count[met]), pa.array(radius[met]), pa.array(list(sums[met]), pa.list_(pa.int64()))],
            names=["cluster", "members", "radius", "sums"],
        )

    parts = state.select("x", "cluster", "upper").mapInArrow(totals, "cluster int, members long, radius double, sums array<long>")
    parts = parts.select("cluster", "members", "radius", F.posexplode("sums").alias("place", "part"))
    whole = parts.groupBy("cluster", "place").agg(
        F.sum("members").alias("members"), F.max("radius").alias("radius"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    )
    members, radius, sums = [0] * k, np.zeros(k), [[0] * dim for _ in range(k)]
    for r in whole.collect():
        members[r["cluster"]], radius[r["cluster"]] = r["members"], r["radius"]
        sums[r["cluster"]][r["place"]] = int(r["total"])
    return members, radius, sums


def moved(centroids: np.ndarray, members: list[int], sums: list[list[int]]) -> np.ndarray:
    """The floored means of the members; an empty cluster keeps its centroid."""
    return np.array([[s // n for s in total] if n else old.tolist() for old, n, total in zip(centroids, members, sums, strict=True)], np.int64)


def fit_clusters(rows: DataFrame, k: int, rounds: int, dim: int, seed: int) -> tuple[np.ndarray, DataFrame | None]:
    """Final centroids and the stored state ``(vec_id, x, cluster, upper, lower, scanned)`` of ``rows(vec_id, x)``.

    Every assignment is written to the shared folder; the driver holds only the
    centroids, their radii and sums. Without rows there is no state.
    """
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return centroids, None
    state = materialize(rows.mapInArrow(scan_all(centroids), _STATE), "cluster-state")
    for _ in range(rounds):
        members, radius, sums = cluster_totals(state, len(centroids), dim)
        new = moved(centroids, members, sums)
        state = materialize(state.mapInArrow(reassign(centroids, new, radius), _STATE), "cluster-state")
        centroids = new
    return centroids, state


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 16,
    rounds: int = 3,
    dim: int = 64,
    scale: int = 64,
    seed: int = 1,
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``, one row per vector that takes part.

    Vectors with another number of components than ``dim`` (at most 64), or
    with nulls, NaN or infinities, take no part; components are floored to
    multiples of 1 / ``scale``, those beyond ``LARGEST`` are cut to it. With
    fewer vectors than ``k`` there are as many clusters as vectors. Repeated
    rows count as often as they occur; equal vectors share a cluster, ties go to
    the smaller number, a cluster that stays empty keeps its centroid. Rows
    without an id are clustered but start no cluster unless there are too few
    others. An empty table gives no rows. Sums that exceed a long are null.
    """
    if dim > 64:
        raise ValueError("squared distances of more than 64 components may not fit a long")
    spark = vectors.sparkSession
    rows = materialize(lattice(vectors, id_col, vector_col, dim, scale), "cluster-rows")
    centroids, state = fit_clusters(rows, k, rounds, dim, seed)
    if state is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, _ = _columns(batch)
                off = x - centroids[batch.column("cluster").to_numpy()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("cluster"), pa.array((off * off).sum(1))], names=["vec_id", "cluster", "distance"]
                )

    found = materialize(state.select("vec_id", "x", "cluster").mapInArrow(measure, "vec_id long, cluster int, distance long"), "cluster-distances")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in sums)

    def as_long(n: int) -> int | None:
        return n if n < 2**63 else None

    per_cluster = [
        (r["cluster"], as_long(int(r["s"])), as_long(total), hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest())
        for r in sums
    ]
    table = spark.createDataFrame(per_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(table, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
