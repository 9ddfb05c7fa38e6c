"""MinHash near-duplicates: fast similarity sketches, banding, exact verification, components.

The sketch is that of fast similarity sketching (Dahlgaard, Knudsen, Thorup,
FOCS 2017): in round i every element of the set is hashed to one bin and gives
it the value i + fraction; a bin keeps its smallest value. In the first t rounds
the bin is hashed, in round t + j it is bin j, so every one of the t coordinates
fills, usually within two rounds, and agreement of coordinates concentrates
around the Jaccard similarity as with independent permutations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.columns import sliced
from tabforge.llm.components import connected_components
from tabforge.llm.shingles import Shingler, mixed
from tabforge.session import materialize

_ROUND = 0x9FB21C651E98DF25
SALT_ROWS = 2_000  # members of a bucket that meet their pivot in one task


def fast_similarity_sketch(elements: np.ndarray, t: int) -> np.ndarray:
    """The t coordinates of a set of 64-bit hashes; a coordinate is (round << 48 | fraction) of the least element."""
    sketch = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    empty = t
    for i in range(2 * t if len(elements) else 0):
        h = mixed(elements + np.uint64((i + 1) * _ROUND % 2**64))
        value = np.uint64(i << 48) | (h >> np.uint64(16))
        if i < t:
            order = np.argsort(value)[::-1]
            bins = ((h[order] & np.uint64(0xFFFF)) * np.uint64(t)) >> np.uint64(16)
            first = np.full(t, np.iinfo(np.uint64).max, np.uint64)
            first[bins] = value[order]  # the last, hence the smallest, stays
            sketch = np.minimum(sketch, first)
        else:
            sketch[i - t] = min(sketch[i - t], value.min())
        empty = np.count_nonzero(sketch == np.iinfo(np.uint64).max)
        if not empty:
            break
    return sketch


def sketch_documents(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """``(doc_id, n_shingles, set_key, band_keys)`` per row, in one pass over the whole texts."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(k)
        for batch in sliced(batches):
            sizes, keys, found = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                if len(s):
                    coordinates = fast_similarity_sketch(s, bands * rows).reshape(bands, rows)
                    found.append([xxhash.xxh3_64_intdigest(c.tobytes(), seed=b) - 2**63 for b, c in enumerate(coordinates)])
                else:
                    found.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "band_keys"],
            )

    schema = "doc_id long, n_shingles long, set_key binary, band_keys array<long>"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(sketch, schema)


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """``(node, n, shingles)`` of whole texts, from ``docs(node, text)``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(k)
        for batch in sliced(batches):
            found = [shingles(t).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["node", "n", "shingles"],
            )

    return docs.mapInArrow(sets, "node long, n long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets satisfy 100 * intersection >= percent * union."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    near = pairs.join(one, "a").join(two, "b").withColumn("common", common)
    return near.where(f"100 * common >= {percent} * (na + nb - common)").select("a", "b")


def star_links(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Verified edges of members with the pivot of their bucket, and ``members`` with the labels these give.

    The pivot is the first member in a hashed order. A node's label is the
    least pivot that it is linked to, or itself: nodes of one label are linked.
    """
    order = F.struct(F.xxhash64("node"), "node")
    pivot = members.groupBy("bucket").agg(F.min_by(F.struct("node", "n"), order).alias("p"), F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("salts"))
    pivot = pivot.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "salts", F.expr("p.node AS pivot"), F.expr("p.n AS m"))
    # A large bucket meets its pivot in several tasks: a member takes the copy of the pivot that its hash says.
    sizes = pivot.where("salt = 0 AND salts > 1").select("bucket", "salts")
    salted = members.join(materialize(sizes, "near-salts"), "bucket", "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("node", F.lit(7)), F.col("salts")), F.lit(0).cast("long"))
    )
    pairs = (
        salted.drop("salts").join(pivot.drop("salts"), ["bucket", "salt"])
        .where(f"node != pivot AND 100 * least(n, m) >= {percent} * greatest(n, m)")
        .select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        .distinct()
    )
    edges = materialize(verified(pairs, sets, percent), "near-edges")
    hub = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("hub"))
    hubs = edges.select(F.col("b").alias("node"), F.col("b").alias("hub"))
    label = hubs.union(hub).groupBy("node").agg(F.min("hub").alias("component"))
    return edges, with_components(members, label)


def block_links(left: DataFrame, sets: DataFrame, percent: int, block: int, shingles: int) -> DataFrame:
    """Edges between components of a bucket that verified links join, compared block against block.

    A bucket is dealt by hash into blocks of about ``block`` members or
    ``shingles`` shingles, whichever is less; a task takes two blocks and counts
    all common shingles as products of 0/1 matrices over the shingles that
    occur twice. First each block is compared with itself, then, under the
    labels that this gives, with the others. A task returns a star per
    component that it finds: fewer edges than its members, whatever the number
    of links.
    """
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / shingles)).alias("blocks")
    dealt = left.join(left.groupBy("bucket").agg(blocks), "bucket").withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit(99)), F.col("blocks"))
    )
    dealt = materialize(dealt.select("bucket", "part", "node", "component"), "near-dealt")
    member = F.struct("node", "shingles")
    packed = dealt.join(sets.select("node", "shingles"), "node").groupBy("bucket", "part").agg(F.array_sort(F.collect_list(member)).alias("sets"))
    packed = materialize(packed, "near-blocks")

    def labelled(members: DataFrame) -> DataFrame:
        """Blocks with the components of their members in the order of the nodes."""
        ordered = F.array_sort(F.collect_list(F.struct("node", "component")))
        return packed.join(members.groupBy("bucket", "part").agg(ordered.alias("labels")), ["bucket", "part"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                two = _block(batch.column(2)[i], batch.column(3)[i]) if batch.num_columns == 4 else None
                a, b = _joined(_block(batch.column(0)[i], batch.column(1)[i]), two, percent)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    within = materialize(labelled(dealt).select("sets", "labels").mapInArrow(compare, "a long, b long"), "near-edges")
    merged = within.groupBy(F.col("a").alias("component")).agg(F.min("b").alias("least"))
    several = dealt.join(left.groupBy("bucket").agg(blocks).where("blocks > 1").select("bucket"), "bucket", "left_semi")
    relabelled = several.join(merged, "component", "left").withColumn("component", F.coalesce("least", "component"))
    one = labelled(relabelled)
    other = one.select("bucket", F.col("part").alias("part2"), F.col("sets").alias("sets2"), F.col("labels").alias("labels2"))
    pairs = one.join(other, "bucket").where("part < part2").select("sets", "labels", "sets2", "labels2")
    return within.union(pairs.mapInArrow(compare, "a long, b long"))


def _block(members: pa.ListScalar, labels: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components, set sizes and all shingles, one set after the other."""
    _, sets = members.values.flatten()
    return labels.values.flatten()[1].to_numpy(), np.diff(sets.offsets.to_numpy()), sets.flatten().to_numpy()


def _joined(one: tuple, two: tuple | None, percent: int, width: int = 8192) -> tuple[list[int], list[int]]:
    """``(component, least component it is joined with)`` for links between members of two blocks, or of one."""
    labels, sizes, shingles = one if two is None else (np.concatenate(x) for x in zip(one, two, strict=True))
    n = len(labels)
    rows_at, columns_at = (slice(0, n), slice(0, n)) if two is None else (slice(0, len(one[0])), slice(len(one[0]), n))
    _, place, times = np.unique(shingles, return_inverse=True, return_counts=True)
    column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[place]
    rows = np.repeat(np.arange(n), sizes)
    rows, column = rows[column >= 0], column[column >= 0]
    common = np.zeros((rows_at.stop - rows_at.start, columns_at.stop - columns_at.start), np.float32)
    for start in range(0, int(column.max(initial=-1)) + 1, width):
        some = (column >= start) & (column < start + width)
        bits = np.zeros((n, width), np.float32)
        bits[rows[some], column[some] - start] = 1
        common += bits[rows_at] @ bits[columns_at].T
    common = common.astype(np.int64)
    near = 100 * common >= percent * (sizes[rows_at, None] + sizes[None, columns_at] - common)
    x, y = np.nonzero(near)
    names, label = np.unique(labels, return_inverse=True)
    touches = np.eye(len(names), dtype=bool)
    a, b = label[rows_at][x], label[columns_at][y]
    touches[a, b] = touches[b, a] = True
    least = np.arange(len(names))
    while True:  # each label takes the least of those it touches, until nothing changes
        lower = np.where(touches, least[None, :], len(names)).min(1)
        lower = lower[lower]
        if np.array_equal(lower, least):
            break
        least = lower
    moved = np.flatnonzero(least != np.arange(len(names)))
    return names[moved].tolist(), names[least[moved]].tolist()


def link_classes(
    members: DataFrame, sets: DataFrame, percent: int, few: int = 12, block: int = 256, shingles: int = 250_000
) -> DataFrame:
    """Verified edges ``(a, b)`` that connect all nodes linked through shared buckets ``members(bucket, node, n)``.

    A star round first joins what resembles a pivot. Every bucket that still has
    more than one label is then compared in full: up to ``few`` members as
    pairs (a number of rows in proportion to the members), more of them in
    blocks. Either way all pairs of members with different labels are checked
    on their full sets, so no link is lost to the size of a bucket.
    """
    edges, left = star_links(members, sets, percent)
    left = materialize(left, "near-members")
    state = left.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("c"))
    open_buckets = state.where("lo != hi").select("bucket", (F.col("c") <= few).alias("small"))
    left = materialize(left.join(open_buckets, "bucket"), "near-left")
    small = left.where("small")
    other = small.selectExpr("bucket", "node AS other", "n AS m", "component AS oc")
    pairs = (
        small.join(other, "bucket")
        .where(f"component < oc AND 100 * least(n, m) >= {percent} * greatest(n, m)")
        .select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b"))
        .distinct()
    )
    in_pairs = materialize(verified(pairs, sets, percent), "near-edges")
    in_blocks = materialize(block_links(left.where("not small"), sets, percent, block, shingles), "near-edges")
    return edges.union(in_pairs).union(in_blocks)


def with_components(nodes: DataFrame, components: DataFrame) -> DataFrame:
    """``nodes`` with their component; a node without an edge is its own."""
    joined = nodes.join(components, "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 85,
    bands: int = 26,
    rows: int = 5,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Texts with equal shingle sets are one class from the start, whatever their
    number, and only its smallest id goes on. A pair of similarity s shares one
    of the band keys with probability 1 - (1 - s^rows)^bands, over 0.9999995 at
    0.85 with the defaults. Links are confirmed on the full sets.

    Null, empty and blank texts have no shingles and stand alone. Equal and
    repeated rows fall into one class; rows that share an id are one document.
    A row without an id gets the component of the documents with its set and is
    kept only if there is none. Empty tables give no rows.
    """
    sketched = materialize(sketch_documents(docs, id_col, text_col, k, bands, rows), "near-sketches")
    classes = materialize(
        sketched.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.min_by("band_keys", "doc_id").alias("band_keys")),
        "near-classes",
    )
    keys = classes.select("node", "n", F.explode("band_keys").alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket")
    members = materialize(keys.join(shared, "bucket"), "near-members")
    wanted = materialize(members.select("node").distinct(), "near-nodes")
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text")).join(wanted, "node", "left_semi")
    sets = materialize(shingle_sets(texts, k), "near-sets")
    edges = link_classes(members, sets, percent)
    component = materialize(with_components(classes.select("node", "set_key"), connected_components(edges)), "near-components")
    found = sketched.select("doc_id", "n_shingles", "set_key").join(component.select("set_key", "component"), "set_key", "left")
    component_id = F.coalesce("component", "doc_id")
    kept = F.when(F.col("doc_id").isNull(), F.col("component").isNull()).otherwise(F.col("doc_id") == component_id)
    return found.select("doc_id", "n_shingles", component_id.alias("component_id"), kept.alias("kept"))
