"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash space, so
sketches of any two texts are samples of their shingle sets under one rule: the
sketch of a union is the union of the sketches, and containment can be estimated
between texts of very different length (with sketches of a fixed size it
cannot). Where no hash is below the bound the least one stands in, so that a
text with words always has a sketch.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.columns import SPACE, unused, without
from tabforge.session import materialize

K = 5
FRACTION = 1 / 8
_DIGITS = 16


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def sketch(text: Column, k: int = K, fraction: float = FRACTION) -> Column:
    """The sorted sketch of a text: the first 16 hex digits of md5 of its ``k``-word shingles below the bound.

    A text of fewer words is one shingle; null, empty and blank texts have an empty sketch.
    """
    bound = F.lit(f"{math.floor(fraction * 2**64):016x}" if fraction < 1 else "g")
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")

    def digest(some: Column) -> Column:
        return F.substring(F.md5(F.array_join(some, " ")), 1, _DIGITS)

    def hashes(w: Column) -> Column:
        several = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: digest(F.slice(w, i, k)))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).when(F.size(w) < k, F.array(digest(w))).otherwise(several)

    def kept(h: Column) -> Column:
        below = F.filter(h, lambda x: x < bound)
        return _let(below, lambda b: F.when((F.size(b) > 0) | (F.size(h) == 0), b).otherwise(F.array(F.array_min(h))))

    return F.array_sort(F.array_distinct(_let(_let(words, hashes), kept)))


def fingerprint(of: str | Column) -> Column:
    """A sketch as one string."""
    return F.array_join(of, "")


def merged(one: Column, two: Column, fraction: float = FRACTION) -> Column:
    """The sketch of the union of two shingle sets."""
    bound = f"{math.floor(fraction * 2**64):016x}" if fraction < 1 else "g"
    both = F.array_sort(F.array_union(one, two))
    below = F.filter(both, lambda x: x < F.lit(bound))
    return F.when((F.size(below) > 0) | (F.size(both) == 0), below).otherwise(F.slice(both, 1, 1))


def resemblance(one: str | Column, two: str | Column) -> Column:
    """Estimated Jaccard similarity of two sketched texts; 1 for two texts without words."""
    common = F.size(F.array_intersect(one, two))
    union = F.size(one) + F.size(two) - common
    return F.when(union == 0, 1.0).otherwise(common / union)


def containment(one: str | Column, two: str | Column) -> Column:
    """Estimated share of the first text's shingles that the second one has; 1 if the first has none."""
    return F.when(F.size(one) == 0, 1.0).otherwise(F.size(F.array_intersect(one, two)) / F.size(one))


CUTS = 4096


def _order_cuts(docs: DataFrame, id_col: str, rows: int) -> tuple[list, dict, int, int]:
    """Different order statistics of the ids, how many cuts fall on those that several do, and slices per gap and for nulls.

    At most ``CUTS`` numbers reach the driver, whatever the size of the table.
    """
    n, filled = docs.agg(F.count(F.lit(1)), F.count(id_col)).first()
    want = max(1, min(CUTS, math.ceil(filled / rows)))
    shares = [i / want for i in range(want + 1)]
    found = docs.agg(F.percentile_approx(id_col, shares, 20 * CUTS).alias("cuts")).first()["cuts"] or []
    hits = Counter(found)
    slices = max(1, math.ceil(filled / want / rows))
    heavy = {cut: hit * slices for cut, hit in hits.items() if hit > 1}
    return sorted(hits), heavy, slices, max(1, math.ceil((n - filled) / rows))


def _bisect(cuts: Column, many: int, value: Column) -> Column:
    """Number of the sorted ``cuts`` that are at most ``value``."""
    steps = [2**k for k in reversed(range(many.bit_length()))]

    def step(at: Column, width: Column) -> Column:
        return F.when((at + width <= many) & (F.try_element_at(cuts, at + width) <= value), at + width).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def id_ranges(docs: DataFrame, id_col: str, order: str, rows: int = 2000) -> Column:
    """Struct of ``coarse`` and ``fine``, ascending with (``id_col``, ``order``), nulls lowest: a range of about ``rows`` rows.

    Coarse ranges lie between order statistics of the ids, so neither outliers
    nor gaps matter to more than one of them. Beyond ``rows * CUTS`` rows they
    are cut on by arithmetic between their own ends. An id that holds several
    cuts, and null, are ranges of their own, cut by the hash ``order`` (a long).
    """
    cuts, heavy, slices, null_slices = _order_cuts(docs, id_col, rows)
    value = F.col(id_col)
    unit = F.col(order) / F.lit(2.0**64) + 0.5

    def cell(share: Column, many: Column | int) -> Column:
        return F.least(F.greatest(F.floor(share * many), F.lit(0)), F.lit(many) - 1 if isinstance(many, int) else many - 1).cast("int")

    nulls = F.struct(F.lit(-1).alias("coarse"), cell(unit, null_slices).alias("fine"))
    if not cuts:
        return nulls
    kind = docs.schema[id_col].dataType
    ends = F.array(*[F.lit(c).cast(kind) for c in cuts])
    weights = F.array(*[F.lit(heavy.get(c, 0)) for c in cuts])

    def placed(at: Column) -> Column:
        low, high = F.get(ends, at - 1), F.get(ends, at)
        weight = F.when(value == low, F.get(weights, at - 1)).otherwise(0)
        share = F.coalesce((value.cast("double") - low.cast("double")) / F.nullif(high.cast("double") - low.cast("double"), F.lit(0.0)), F.lit(0.0))
        apart = F.struct((2 * at).alias("coarse"), cell(unit, F.greatest(weight, F.lit(1))).alias("fine"))
        return F.when(weight > 0, apart).otherwise(F.struct((2 * at + 1).alias("coarse"), cell(share, slices).alias("fine")))

    return F.when(value.isNull(), nulls).otherwise(_let(_bisect(ends, len(cuts), value), placed))


def _heads(keyed: DataFrame, id_col: str, part: str, order: str) -> DataFrame:
    """The first row of each range, and ``to``: the range before it, or the last of all for the lowest.

    Ranges are ordered within their coarse range; only the coarse ones, 2 * CUTS
    + 3 at most, meet in one window.
    """
    first = keyed.groupBy(F.col(f"{part}.coarse").alias("coarse"), F.col(f"{part}.fine").alias("fine")).agg(
        F.max(F.struct(F.col(id_col).alias("id"), F.col(order).alias("hash"))).alias("top")
    )
    first = materialize(first, "next-heads")
    everything = Window.partitionBy(F.lit(0))
    tops = first.groupBy("coarse").agg(F.min("fine").alias("low"), F.max("fine").alias("high"))
    # The row after the last of a range is the first of the range below; below the lowest comes the highest.
    above = F.lead(F.struct("coarse", "low")).over(Window.orderBy("coarse"))
    links = tops.select(F.col("coarse").alias("of"), F.coalesce(above, F.min(F.struct("coarse", "low")).over(everything)).alias("beyond"))
    within = F.lead("fine").over(Window.partitionBy("coarse").orderBy("fine"))
    near = first.withColumn("up", within).join(links, F.col("coarse") == F.col("of"))
    to = F.when(F.col("up").isNotNull(), F.struct(F.col("coarse"), F.col("up").alias("fine"))).otherwise(
        F.struct(F.col("beyond.coarse").alias("coarse"), F.col("beyond.low").alias("fine"))
    )
    return near.select(F.struct(F.struct("coarse", "fine").alias("part"), "top.id", "top.hash", to.alias("to")).alias("head"))


def with_next(
    docs: DataFrame, carried: dict[str, Column], id_col: str = "doc_id", text_col: str = "text", rows: int = 2000
) -> DataFrame:
    """``docs`` with ``own`` and ``next``, structs of the ``carried`` expressions of a document and of the next one.

    Next is the one that follows in descending ``id_col`` (a number; null last;
    equal ids by a hash of the text; identical rows in any order); after the
    last comes the first. Documents are cut into ranges of about ``rows`` rows at
    order statistics of the ids, equal ids by the hash (``id_ranges``), and the
    first row of each range is copied to the end of the range that it follows.
    Each row is shuffled once and no window is larger than a range. Only rows
    with the same id and text cannot be parted; they cost spill, not
    correctness. Input columns called own or next are replaced.
    """
    docs = docs.select(*without(docs, ["own", "next"]))
    order, part, ghost, head = unused(docs, "next_order", "next_part", "next_ghost", "next_head")
    hashed = docs.withColumn(order, F.xxhash64(text_col))
    keyed = hashed.withColumn(part, id_ranges(docs, id_col, order, rows))
    first = materialize(_heads(keyed, id_col, part, order).withColumnRenamed("head", head), "next-links")
    same = (
        (F.col(part) == F.col(f"{head}.part"))
        & F.col(id_col).eqNullSafe(F.col(f"{head}.id"))
        & (F.col(order) == F.col(f"{head}.hash"))
    )
    here, there = F.struct(F.col(part).alias("part"), F.lit(False).alias("copy")), F.struct(F.col(f"{head}.to").alias("part"), F.lit(True).alias("copy"))
    placed = keyed.join(first, same, "left").withColumn(
        ghost, F.explode(F.when(F.col(head).isNull(), F.array(here)).otherwise(F.array(here, there)))
    )
    placed = placed.withColumn("own", F.struct(*[e.alias(n) for n, e in carried.items()]))
    window = Window.partitionBy(f"{ghost}.part").orderBy(f"{ghost}.copy", F.col(id_col).desc_nulls_last(), F.col(order).desc())
    found = placed.withColumn("next", F.lead("own").over(window)).where(f"NOT {ghost}.copy")
    return found.drop(order, part, ghost, head)


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last third replaced by as many of the first characters of ``following`` (or all it has)."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(following, F.lit(1), third))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and how alike these and the next document are.

    Null texts count as empty. Equal texts have equal fingerprints; two texts
    without words resemble each other fully, one without words and one with
    words not at all. A table of one row has itself as next; an empty one gives
    no rows.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    both = with_next(slim, {"text": F.col("text"), "sketch": sketch(F.col("text"))})
    edited = both.select(
        "doc_id",
        F.col("own.sketch").alias("sketch"),
        F.col("next.sketch").alias("next_sketch"),
        F.char_length("own.text").cast("long").alias("n_chars"),
        edited_text(F.col("own.text"), F.col("next.text")).alias("edited"),
    ).withColumn("edited_sketch", sketch(F.col("edited")))
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("sketch").alias("fingerprint"),
        fingerprint("edited_sketch").alias("edited_fingerprint"),
        resemblance("sketch", "edited_sketch").alias("near_edited"),
        resemblance("sketch", "next_sketch").alias("near_next"),
        containment("sketch", "edited_sketch").alias("held_by_edited"),
        containment("sketch", "next_sketch").alias("held_by_next"),
    )
