"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import (
    centroids,
    fingerprints,
    html_extract,
    mixing,
    near_dedup,
    personal_data,
    secret_scan,
    sentencepiece_tokens,
    token_files,
    toxicity,
    vptree,
    warc_revisits,
    whitening,
)

VP_RELAX = 1.0  # exact

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return planned.select("doc_id", "size", "source_size", "target", taken, "copies")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
    CAST(2 * source_size AS DOUBLE) AS most
  FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT source, source_size, least(most, max(level) OVER () * weight) AS target FROM l
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
    CAST(('0x' || substr(md5('42:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM r
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM c
"""


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


def _sketch_sql(text: str) -> str:
    words = f"regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"
    return f"""(SELECT list_sort(list_distinct(CASE WHEN len(b) > 0 OR len(h) = 0 THEN b ELSE [list_min(h)] END))
      FROM (SELECT h, list_filter(h, lambda x: x < '2000000000000000') AS b
      FROM (SELECT CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
          WHEN len(w) < 5 THEN [substr(md5(array_to_string(w, ' ')), 1, 16)]
          ELSE list_transform(range(1, len(w) - 3), lambda i: substr(md5(array_to_string(list_slice(w, i, i + 4), ' ')), 1, 16)) END AS h
      FROM (SELECT {words} AS w))))"""


OP3_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), n AS (
  SELECT *, coalesce(lead(text) OVER o, first_value(text) OVER o) AS following FROM d WINDOW o AS (ORDER BY doc_id DESC NULLS LAST)
), e AS (
  SELECT *, substr(text, 1, length(text) - length(text) // 3) || substr(following, 1, length(text) // 3) AS edited FROM n
), s AS (
  SELECT *, {_sketch_sql('text')} AS a, {_sketch_sql('following')} AS b, {_sketch_sql('edited')} AS c FROM e
), i AS (
  SELECT *, len(list_intersect(a, c)) AS ac, len(list_intersect(a, b)) AS ab FROM s
)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
  array_to_string(a, '') AS fingerprint, array_to_string(c, '') AS edited_fingerprint,
  CASE WHEN len(a) + len(c) = 0 THEN 1.0::DOUBLE ELSE ac::DOUBLE / (len(a) + len(c) - ac) END AS near_edited,
  CASE WHEN len(a) + len(b) = 0 THEN 1.0::DOUBLE ELSE ab::DOUBLE / (len(a) + len(b) - ab) END AS near_next,
  CASE WHEN len(a) = 0 THEN 1.0::DOUBLE ELSE ac::DOUBLE / len(a) END AS held_by_edited,
  CASE WHEN len(a) = 0 THEN 1.0::DOUBLE ELSE ab::DOUBLE / len(a) END AS held_by_next
FROM i
"""


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_tokens.verify_documents(table(spark, sf_dir, "documents"), model)


def page_records(pages: DataFrame) -> DataFrame:
    """WARC records that the pages give: each page as a response, and a later visit that found it not modified.

    By the id in turn, the later visit repeats the entity tag, repeats it as a
    weak one, has another one, or only the date of the last change.
    """
    turn = F.pmod(F.col("page_id"), F.lit(4))
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    changed = F.concat(F.lit("day "), F.floor(F.col("page_id") / 7).cast("string"))
    length = F.octet_length("html").cast("string")
    date = F.col("page_id") * 3600
    response = F.struct(
        F.concat(F.lit("response:"), F.col("page_id")).alias("record_id"),
        F.col("url").alias("uri"),
        date.alias("date"),
        F.lit("response").alias("type"),
        F.lit(200).alias("status"),
        F.create_map(
            *[F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), length, F.lit("ETag"), tag],
            *[F.lit("Last-Modified"), changed, F.lit("Cache-Control"), F.lit("max-age=60")],
        ).alias("headers"),
    )
    fresh = F.create_map(
        *[F.lit("etag"), F.when(turn == 0, tag).when(turn == 1, F.concat(F.lit("W/"), tag)).when(turn == 2, F.concat(F.lit('"'), F.md5("url"), F.lit('"')))],
        *[F.lit("Last-Modified"), F.when(turn == 3, changed), F.lit("Cache-Control"), F.lit("max-age=600")],
        *[F.lit("Content-Length"), F.lit("0"), F.lit("Expires"), (date + 90000).cast("string")],
    )
    revisit = F.struct(
        F.concat(F.lit("revisit:"), F.col("page_id")).alias("record_id"),
        F.concat(F.col("url"), F.lit("#later")).alias("uri"),
        (date + 86400 * (1 + F.pmod(F.col("page_id"), F.lit(5)))).alias("date"),
        F.lit("revisit").alias("type"),
        F.lit(304).alias("status"),
        F.map_filter(fresh, lambda k, v: v.isNotNull()).alias("headers"),
    )
    records = pages.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")
    return records.withColumn("digest", F.lit(None).cast("string"))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisits.resolve_revisits(page_records(table(spark, sf_dir, "pages")))
    return found.select("record_id", "uri", "date", "outcome", "refers_to", "refers_to_date", warc_revisits.header_text("merged").alias("headers"))


OP5_SQL = r"""
WITH p AS (
  SELECT page_id, url, '"' || md5(html) || '"' AS tag, 'day ' || CAST(CAST(floor(page_id / 7) AS BIGINT) AS VARCHAR) AS changed,
    CAST(strlen(html) AS VARCHAR) AS length, regexp_replace(url, '#.*$', '') AS bare, page_id * 3600 AS date FROM pages
), q AS (
  SELECT *, regexp_matches(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)\??(.*)$') AS is_uri,
    regexp_replace(lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)\??(.*)$', 1)), '^www\.|:(?:80|443)$', '', 'g') AS host,
    regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)\??(.*)$', 2) AS path,
    list_sort(list_filter(string_split(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)([^?]*)\??(.*)$', 3), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_[a-z]+|ref|gclid|fbclid)(?:=|$)'))) AS params
  FROM p
), k AS (
  SELECT *, CASE WHEN is_uri THEN host || CASE WHEN path = '' THEN '/' ELSE path END
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END ELSE bare END AS key FROM q
), v AS (
  SELECT *, date + 86400 * (1 + page_id % 5) AS visited,
    CASE page_id % 4 WHEN 0 THEN tag WHEN 1 THEN 'W/' || tag WHEN 2 THEN '"' || md5(url) || '"' END AS new_tag,
    CASE page_id % 4 WHEN 3 THEN changed END AS new_changed FROM k
), j AS (
  SELECT v.*, r.page_id AS target, r.date AS target_date, r.tag AS old_tag, r.changed AS old_changed, r.length AS old_length
  FROM v LEFT JOIN k r ON v.key = r.key AND r.date < v.visited
  QUALIFY row_number() OVER (PARTITION BY v.page_id ORDER BY r.date DESC NULLS LAST, 'response:' || r.page_id DESC) = 1
), o AS (
  SELECT *, coalesce(regexp_replace(new_tag, '^W/', '') = old_tag, new_changed = old_changed) AS agrees FROM j
), f AS (
  SELECT *, CASE WHEN target IS NULL THEN 'missing' WHEN agrees THEN 'resolved' WHEN agrees IS NULL THEN 'unchecked' ELSE 'mismatch' END AS outcome FROM o
)
SELECT 'revisit:' || page_id AS record_id, url || '#later' AS uri, visited AS date, outcome,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN 'response:' || target END AS refers_to,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN target_date END AS refers_to_date,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN 'cache-control: max-age=600' || chr(10) || 'content-length: ' || old_length || chr(10)
    || 'content-type: text/html' || chr(10) || 'etag: ' || coalesce(new_tag, old_tag) || chr(10) || 'expires: ' || CAST(date + 90000 AS VARCHAR)
    || chr(10) || 'last-modified: ' || coalesce(new_changed, old_changed) END AS headers
FROM f
"""


def op6_toxicity_counterfactual(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", "held_out", "score", "predicted")


def op7_secret_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), carried=["doc_id"])
    counts = [secret_scan.count_of("base", kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]]
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.listed("base"), 256).alias("base_sha256"), secret_scan.listed("spans").alias("spans")
    )


def op8_html_chain_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_extract.extract_text(pages, html_extract.fit_extractor(pages))
    return found.select("page_id", "url", "text", "n_chars")


def op9_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.search_index(vptree.build_index(vectors), vectors.where("vec_id % 50 = 0"), k=5, relax=VP_RELAX)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), n AS (
  SELECT *, sqrt(list_reduce(list_transform(v, lambda x: x * x), lambda s, x: s + x)) AS n FROM v
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    max(list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda s, x: s + x) / (q.n * c.n)) AS score
  FROM n q JOIN n c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v) GROUP BY q.vec_id, c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op10_token_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    path = token_files.token_path(spark)
    rows = token_files.write_token_files(
        table(spark, sf_dir, "documents"), lambda: token_files.byte_level_encoder(tokenizer, special_as_text=False), path, end_id=0
    )
    read = token_files.read_documents(token_files.with_starts(rows), path)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "position")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def _clusters_sql(k: int, rounds: int) -> str:
    """Lloyd rounds, each an assignment by all distances and a table of floored means."""

    def assigned(no: int) -> str:
        return f"""a{no} AS (
  SELECT row_no, arg_min(c.no, (d.away, c.no)) AS cluster, min(d.away) AS distance FROM v JOIN c{no} c ON true,
    LATERAL (SELECT CAST(list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS BIGINT) AS away) d
  GROUP BY row_no
)"""

    steps = [f"""c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, x) - 1 AS no, x FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, x) <= {k}
)"""]
    for no in range(rounds):
        steps += [assigned(no), f"""m{no} AS (
  SELECT cluster AS no, i, sum(CAST(x[i] AS HUGEINT)) AS s, count(*) AS n FROM a{no} JOIN v USING (row_no), range(1, 65) t(i) GROUP BY cluster, i
)""", f"""c{no + 1} AS (
  SELECT c.no, coalesce(list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) FILTER (s IS NOT NULL), any_value(c.x)) AS x
  FROM c{no} c LEFT JOIN m{no} USING (no) GROUP BY c.no
)"""]
    return f"""
WITH e AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda c: c) AS e FROM embeddings
), v AS (
  SELECT row_number() OVER () AS row_no, vec_id,
    list_transform(e, lambda c: CAST(greatest(least(floor(64 * c), 134217728), -134217728) AS BIGINT)) AS x
  FROM e WHERE len(e) = 64 AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), {", ".join([*steps, assigned(rounds)])}, s AS (
  SELECT cluster, sum(distance) AS s FROM a{rounds} GROUP BY cluster
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(s.s AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(s) FROM s) AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (row_no) JOIN s USING (cluster) JOIN c{rounds} c ON c.no = cluster
"""


OP11_SQL = _clusters_sql(16, 3)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, sf_dir, "documents"), carried=["doc_id"])
    counts = [personal_data.count_of("spans", kind).alias(f"n_{kind}") for kind in personal_data.KINDS]
    base = personal_data.listed(personal_data.base_of("spans"))
    scores = F.array_join(F.col("spans.score").cast("array<string>"), ",").alias("scores")
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), personal_data.listed("spans").alias("spans"), scores)


def _personal_sql() -> str:
    """Candidates of each pattern with their positions, then validators, context and overlaps."""
    pii = personal_data
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}",
        "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    }

    def words(some: tuple[str, ...]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in some) + "]"

    found = " UNION ALL ".join(
        f"""SELECT row_no, text, {no} AS kind, regexp_extract_all(text, '(?s)(.*?)({p})', 1) AS b, regexp_extract_all(text, '(?s)(.*?)({p})', 2) AS w FROM d"""
        for no, p in enumerate(patterns.values())
    )
    lengths = ", ".join(f"'{c}': {n}" for c, n in pii.IBAN_LENGTHS.items())
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    scores = " ".join(f"WHEN {no} THEN {pii.SCORES[k]}" for no, k in enumerate(pii.KINDS))
    speaks = " ".join(f"WHEN {no} THEN list_has_any(near, {words(pii.WORDS_FOR[k])})" for no, k in enumerate(pii.KINDS))
    names = " ".join(f"WHEN {no} THEN '{k}'" for no, k in enumerate(pii.KINDS))
    counts = ", ".join(f"CAST(count(*) FILTER (kind = {no}) AS BIGINT) AS n_{k}" for no, k in enumerate(pii.KINDS))
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
), f AS ({found}), g AS (
  SELECT row_no, text, kind, w[i] AS w, CAST(list_sum(list_transform(b[:i], lambda t: length(t))) + coalesce(list_sum(list_transform(w[:i - 1], lambda t: length(t))), 0) AS BIGINT) AS s
  FROM f, LATERAL (SELECT unnest(range(1, len(b) + 1)) AS i)
), l AS (
  SELECT *, CASE WHEN kind = 4 THEN regexp_extract(w, '^(?:[A-Z0-9]\x20?){{' || (coalesce(MAP {{{lengths}}}[substr(w, 1, 2)], 99) - 1) || '}}[A-Z0-9]') ELSE w END AS cut,
    reverse(regexp_replace(w, '[^0-9]', '', 'g')) AS digits
  FROM g WHERE kind <> 2 OR length(w) BETWEEN 14 AND 37
), h AS (
  SELECT *, s + length(cut) AS e, CASE kind
    WHEN 1 THEN len(list_filter(string_split(w, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || substr(ltrim(p, '0'), 1, 3) AS INTEGER) > 255)) = 0
    WHEN 2 THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, CASE WHEN kind = 2 THEN length(digits) + 1 ELSE 1 END), lambda i:
      CASE WHEN i % 2 = 1 THEN CAST(digits[i] AS INTEGER) ELSE CAST(substr('0246813579', CAST(digits[i] AS INTEGER) + 1, 1) AS INTEGER) END)) % 10 = 0
    WHEN 3 THEN length(digits) BETWEEN 10 AND 15
    WHEN 4 THEN cut <> '' AND NOT regexp_matches(substr(text, CAST(s + length(cut) + 1 AS BIGINT), 1), '^[A-Za-z0-9]') AND list_reduce(list_prepend(0, list_transform(
        string_split(substr(replace(cut, ' ', ''), 5) || substr(replace(cut, ' ', ''), 1, 4), ''), lambda c: strpos('0123456789{upper}', c) - 1)),
        lambda a, x: (a * CASE WHEN x < 10 THEN 10 ELSE 100 END + x) % 97) = 1
    WHEN 5 THEN substr(w, 1, 3) NOT IN ('000', '666') AND substr(w, 1, 1) <> '9' AND substr(w, 5, 2) <> '00' AND substr(w, 8) <> '0000'
    ELSE true END AS good
  FROM l
), n AS (
  SELECT row_no, kind, s, e, list_concat(
    regexp_extract_all(translate(substr(text, CAST(greatest(s - 40, 0) + 1 AS BIGINT), CAST(least(s, 40) AS BIGINT)), '{upper}', '{lower}'), '[a-z]+(?:-[a-z]+)?'),
    regexp_extract_all(translate(substr(text, CAST(e + 1 AS BIGINT), 40), '{upper}', '{lower}'), '[a-z]+(?:-[a-z]+)?')) AS near
  FROM h WHERE good
), r AS (
  SELECT *, greatest(0, least(100, CASE kind {scores} END + {pii.FOR} * CAST(CASE kind {speaks} END AS INTEGER)
    - {pii.AGAINST} * CAST(list_has_any(near, {words(pii.WORDS_AGAINST)}) AS INTEGER))) AS score FROM n
), k AS (
  SELECT * FROM r WHERE kind < {pii.BASE} OR (score >= 60 AND NOT EXISTS (
    SELECT 1 FROM r o WHERE o.kind < {pii.BASE} AND o.row_no = r.row_no AND o.s < r.e AND r.s < o.e))
), a AS (
  SELECT row_no, {counts}, string_agg((CASE kind {names} END) || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans,
    string_agg((CASE kind {names} END) || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < {pii.BASE}) AS base,
    string_agg(CAST(score AS VARCHAR), ',' ORDER BY s, kind) AS scores
  FROM k GROUP BY row_no
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.KINDS)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN a USING (row_no)
"""


OP13_SQL = _personal_sql()


def queries() -> dict[str, Query]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_minhash_near_dedup": op2_minhash_near_dedup,
        "op3_scaled_fingerprints": op3_scaled_fingerprints,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_warc_revisits": op5_warc_revisits,
        "op6_toxicity_counterfactual": op6_toxicity_counterfactual,
        "op7_secret_randomness": op7_secret_randomness,
        "op8_html_chain_field": op8_html_chain_field,
        "op9_vantage_point_search": op9_vantage_point_search,
        "op10_token_bit_planes": op10_token_bit_planes,
        "op11_centroid_clusters": op11_centroid_clusters,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_personal_data": op13_personal_data,
    }


def oracles() -> dict[str, str]:
    return {
        "op1_mix_sources": OP1_SQL,
        "op3_scaled_fingerprints": OP3_SQL,
        "op5_warc_revisits": OP5_SQL,
        "op9_vantage_point_search": OP9_SQL,
        "op11_centroid_clusters": OP11_SQL,
        "op13_personal_data": OP13_SQL,
    }
