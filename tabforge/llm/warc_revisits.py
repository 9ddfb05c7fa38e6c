"""WARC revisit records: resolving "not modified" captures to the response that they repeat.

Records are rows: ``record_id``, ``uri``, ``date`` (a timestamp or a number),
``type`` (response or revisit), ``status``, ``headers`` (map of strings) and
``digest`` of the payload. Payloads stay where they are; a resolved revisit
names the record that holds its body.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.columns import without
from tabforge.session import materialize

# Fields that a 304 response may not change in the stored one (RFC 9111, section 3.2, and WARC practice).
KEPT_FIELDS = (
    "content-encoding", "content-length", "content-md5", "content-range", "content-type", "transfer-encoding", "connection", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "upgrade",
)
# Query parameters that only say where a visitor came from.
TRACKING = r"(?:utm_[a-z]+|ref|gclid|fbclid)"


def canonical_uri(uri: str | Column) -> Column:
    """Host in lower case without www. and default port, path, other query parameters in order; no scheme, no fragment.

    What does not look like a URI is kept as it is, without its fragment; null stays null.
    """
    bare = F.regexp_replace(uri, r"#.*$", "")
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)\??(.*)$"
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, parts, 1)), r"^www\.|:(?:80|443)$", "")
    path = F.regexp_extract(bare, parts, 2)
    query = F.filter(F.split(F.regexp_extract(bare, parts, 3), "&"), lambda p: (p != "") & ~F.rlike(p, F.lit(rf"^{TRACKING}(?:=|$)")))
    tail = F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(query), "&"))).otherwise("")
    return F.when(F.rlike(bare, F.lit(parts)), F.concat(host, F.when(path == "", "/").otherwise(path), tail)).otherwise(bare)


def fields(headers: Column) -> Column:
    """Header fields with names in lower case; of names that differ in case only the last one counts. Null gives no fields."""
    entries = F.transform(
        F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(last)


def merged_fields(stored: Column, fresh: Column) -> Column:
    """Stored fields, those that ``fresh`` may change replaced or added."""
    allowed = F.map_filter(fresh, lambda k, v: ~k.isin(*KEPT_FIELDS))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)


def agreement(stored: Column, fresh: Column, stored_digest: Column, digest: Column) -> Column:
    """True if all validators that both have agree, false if one differs, null if they have none in common.

    Entity tags are compared weakly; the date of the last change counts only without two tags.
    """
    tag = [F.regexp_replace(F.try_element_at(f, F.lit("etag")), "^W/", "") for f in (stored, fresh)]
    changed = [F.try_element_at(f, F.lit("last-modified")) for f in (stored, fresh)]
    by_field = F.coalesce(tag[0] == tag[1], changed[0] == changed[1])
    by_digest = stored_digest == digest
    return F.when(by_field.isNull(), by_digest).when(by_digest.isNull(), by_field).otherwise(by_field & by_digest)


def resolve_revisits(records: DataFrame, rows: int = 50_000) -> DataFrame:
    """One row per revisit: its columns, ``outcome``, ``refers_to``, ``refers_to_date`` and ``merged`` header fields.

    The response is the latest full one (status 200) with the same canonical
    URI and a strictly earlier date; of several at that date the one with the
    largest id. ``outcome`` is resolved, unchecked (no validator in common),
    mismatch (a validator differs; nothing is merged) or missing (no such
    response; also for null URIs and dates). Repeated records are resolved each.

    A URI may hold any share of the records: they are cut into ranges of time
    of about ``rows`` records, the last response of each URI and range is
    carried into the later ranges, and within a range the search is a window.
    Input columns with the names of the added ones are replaced.
    """
    records = records.select(*without(records, ["outcome", "refers_to", "refers_to_date", "merged"]))
    when = F.col("date").cast("double")
    seen = records.agg(F.min(when).alias("lo"), F.max(when).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi, ranges = seen["lo"] or 0.0, seen["hi"] or 0.0, max(1, math.ceil(seen["n"] / rows))
    width = (hi - lo) / ranges or 1.0
    own = F.struct(*[F.col(f"`{c}`") for c in records.columns])
    full = (F.col("type") == "response") & (F.col("status") == 200) & F.col("date").isNotNull()
    response = F.struct(
        F.col("date"), F.col("record_id").alias("id"), fields(F.col("headers")).alias("fields"), F.col("digest")
    )
    keyed = records.where("type IN ('response', 'revisit')").select(
        # A null URI meets nothing; a key of its own keeps such rows apart.
        F.coalesce(canonical_uri("uri"), F.concat(F.lit("\0"), F.xxhash64("record_id", "date").cast("string"))).alias("key"),
        F.col("uri").isNull().alias("lost"),
        F.least(F.floor((when - lo) / width), F.lit(ranges - 1)).alias("range"),
        (F.col("type") == "response").alias("later"),
        F.when(full & F.col("uri").isNotNull(), response).alias("response"),
        F.when(F.col("type") == "revisit", own).alias("own"),
        F.col("date").alias("at"),
        F.col("record_id").alias("id"),
    )
    newest = F.max_by("response", F.struct("at", "id"))
    carried = keyed.where("response IS NOT NULL").groupBy("key", "range").agg(newest.alias("last"))
    carried = materialize(carried, "warc-last")
    needed = keyed.where("own IS NOT NULL").select("key", "range").distinct()
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        needed.join(carried, ["key", "range"], "full")
        .withColumn("before", F.last("last", ignorenulls=True).over(before))
        .where("before IS NOT NULL")
        .select("key", "range", "before")
    )
    within = Window.partitionBy("key", "range").orderBy("at", "later", "id").rowsBetween(Window.unboundedPreceding, -1)
    found = (
        keyed.withColumn("inside", F.last("response", ignorenulls=True).over(within))
        .where("own IS NOT NULL")
        .join(earlier, ["key", "range"], "left")
        .withColumn("target", F.when(F.col("at").isNotNull() & ~F.col("lost"), F.coalesce("inside", "before")))
    )
    fresh, stored = fields(F.col("own.headers")), F.col("target.fields")
    agrees = agreement(stored, fresh, F.col("target.digest"), F.col("own.digest"))
    outcome = F.when(F.col("target").isNull(), "missing").when(agrees, "resolved").when(agrees.isNull(), "unchecked").otherwise("mismatch")
    taken = F.col("outcome").isin("resolved", "unchecked")
    judged = found.withColumn("outcome", outcome).select(
        "own",
        "outcome",
        F.when(taken, F.col("target.id")).alias("refers_to"),
        F.when(taken, F.col("target.date")).alias("refers_to_date"),
        F.when(taken, merged_fields(stored, fresh)).alias("merged"),
    )
    return judged.select("own.*", "outcome", "refers_to", "refers_to_date", "merged")


def header_text(headers: str | Column) -> Column:
    """Header fields as lines, sorted by name."""
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(F.array_sort(lines), "\n")
