"""The named queries of this subpackage, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bisector, decontam, jaccard, langid, mixing, pii, quality, radix_dedup, sharding, suffix_dedup, term_audit, toxicity, warc
from strata.llm.common import fold, read, ship
from strata.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op1_bayes_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 3) == 1)
    model = langid.fit(docs.where("NOT held_out"))
    return langid.with_language(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query(
    "op2_warc_chunks",
    r"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
    d AS (SELECT page_id, t, sha1(t) AS h, min(page_id) OVER (PARTITION BY t) AS first_id FROM p),
    b AS (
      SELECT page_id, strlen(t) AS n, first_id,
             list_aggregate(list_transform(range(8), lambda i:
               lpad(translate(lower(to_base(CAST('0x' || substr(h, CAST(5 * i + 1 AS INT), 5) AS BIGINT), 32)),
                    '0123456789abcdefghijklmnopqrstuv', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'), 4, 'A')),
               'string_agg', '') AS digest
      FROM d)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
    FROM b
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archive(read(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).drop("url")


@query(
    "op3_radix_dedup",
    r"""
    WITH d AS (
      SELECT doc_id, length(coalesce(text, '')) AS points,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
      FROM documents),
    g AS (
      SELECT doc_id, norm,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size
      FROM d)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.dedup(read(spark, sf_dir, "documents"))


@query("op4_weak_supervision_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(read(spark, sf_dir, "documents")))


@query("op5_hash_tree_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"))


@query("op6_suffix_repeats")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    # A cut may fall within a character; what is left of it shows as a replacement character.
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


@query("op7_line_field_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    field = quality.fit(docs.where("NOT held_out").select("doc_id", "text"), labels)
    scored = quality.with_quality(docs.select("doc_id", "held_out", "text"), field)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op8_bm25_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.with_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.col("leaks.items").alias("item_ids"))


@query(
    "op9_prefix_filter_groups",
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 3
               THEN list_transform(range(len(words) - 2), lambda i: array_to_string(words[i + 1 : i + 3], ' '))
               WHEN len(words) > 0 THEN ['<' || array_to_string(words, ' ')] ELSE [] END) AS shingle
      FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY ALL),
    l AS (
      SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * shared >= 90 * (nx.n + ny.n - shared)),
    r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
    c AS (SELECT x, min(y) AS y FROM r GROUP BY x)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.y, w.doc_id)) AS component_id
    FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.x = w.doc_id
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(read(spark, sf_dir, "documents"), n=3, percent=90)


@query(
    "op10_water_filling_mix",
    r"""
    WITH d AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             md5('17:' || CAST(doc_id AS VARCHAR)) AS draw
      FROM documents),
    s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
      FROM d GROUP BY source),
    f AS (
      SELECT *, source_size * 3.0::DOUBLE AS cap, (source_size * 3.0::DOUBLE) / weight AS fill,
             sum(CAST(source_size AS DOUBLE)) OVER () AS everything, sum(weight) OVER () AS weights
      FROM s),
    l AS (
      SELECT *, (everything - coalesce(sum(cap) OVER before, 0)) / (weights - coalesce(sum(weight) OVER before, 0)) AS level
      FROM f
      WINDOW before AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    t AS (
      SELECT source, source_size,
             CASE WHEN fill <= level THEN cap ELSE weight * max(CASE WHEN fill > level THEN level END) OVER () END AS target
      FROM l),
    w AS (
      SELECT source, source_size, target,
             CASE WHEN source_size = 0 THEN 0 ELSE least(floor(target / source_size), 3) END AS whole
      FROM t),
    p AS (
      SELECT d.doc_id, d.size, w.source_size, w.target, CAST(w.whole AS BIGINT) AS whole,
             CAST(round(w.target - w.whole * w.source_size) AS BIGINT) AS part,
             CAST(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
      FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source)
    SELECT doc_id, size, source_size, target, whole * size + greatest(0, least(size, part - upto + size)) AS taken FROM p
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("source")


@query("op11_recurrent_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    network = toxicity.fit(docs.where("NOT held_out").select("doc_id", "text"), labels)
    scored = toxicity.with_toxicity(docs.select("doc_id", "held_out", "text"), network)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _round(n: int) -> str:
    """SQL of one round of assigning and moving centroids ``c{n}`` to ``c{n + 1}``."""
    return f"""
    a{n} AS MATERIALIZED (
      SELECT vec_id, v.x, v.y, min({{'d': v.xx - 2 * list_dot_product(v.y, c.y) + c.yy, 'n': c.n}}) AS best
      FROM v, c{n} AS c GROUP BY ALL),
    c{n + 1} AS MATERIALIZED (
      SELECT n, x, list_transform(x, lambda e: CAST(e AS DOUBLE)) AS y,
             list_dot_product(list_transform(x, lambda e: CAST(e AS DOUBLE)), list_transform(x, lambda e: CAST(e AS DOUBLE))) AS yy
      FROM (SELECT c.n, coalesce(m.x, c.x) AS x
            FROM c{n} AS c LEFT JOIN (
              SELECT n, list(m ORDER BY i) AS x
              FROM (SELECT n, i, CAST(floor(sum(e) / count(*)) AS BIGINT) AS m
                    FROM (SELECT best.n AS n, unnest(x) AS e, unnest(range(64)) AS i FROM a{n}) GROUP BY n, i)
              GROUP BY n) AS m ON m.n = c.n))"""


@query(
    "op12_bisector_clusters",
    f"""
    WITH v AS MATERIALIZED (
      SELECT vec_id, x, list_transform(x, lambda e: CAST(e AS DOUBLE)) AS y,
             list_dot_product(list_transform(x, lambda e: CAST(e AS DOUBLE)), list_transform(x, lambda e: CAST(e AS DOUBLE))) AS xx
      FROM (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)),
    c0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS n, x, y, xx AS yy
      FROM v ORDER BY sha256('2:' || vec_id) LIMIT 40),
    {",".join(_round(n) for n in range(5))},
    f AS (SELECT vec_id, min({{'d': v.xx - 2 * list_dot_product(v.y, c.y) + c.yy, 'n': c.n}}) AS best FROM v, c5 AS c GROUP BY vec_id)
    SELECT vec_id, CAST(best.n AS INT) AS cluster, CAST(best.d AS BIGINT) AS distance,
           CAST(sum(best.d) OVER (PARTITION BY best.n) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c5.x, ',')) AS centroid_sha256
    FROM f JOIN c5 ON c5.n = best.n
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisector.cluster(read(spark, sf_dir, "embeddings"))


@query(
    "op13_term_pointer_audit",
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    g AS (SELECT DISTINCT lang, source FROM d),
    w AS (
      SELECT doc_id, lang, source, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM d),
    k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10),
    v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS n FROM k GROUP BY lang),
    c AS (SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
    s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
    f AS (
      SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(s.n, 0) + 2 * v.v) AS p,
             1 + 1000000000::HUGEINT * (k.n + 2) // (v.n + 2 * v.v) AS q
      FROM g JOIN k USING (lang) JOIN v USING (lang)
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
      LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
    pairs AS (
      SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(m.value, 0) AS value
      FROM g JOIN g AS h ON h.lang = g.lang AND h.source <> g.source
      LEFT JOIN (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM f AS a JOIN f AS b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL) AS m
      ON m.lang = g.lang AND m.source = g.source AND m.item = h.source),
    terms AS (
      SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM f WHERE n > 0 AND p > q),
    r AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
    FROM r WHERE part = 'pair' OR rank <= 10
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_audit.audit(read(spark, sf_dir, "documents"))
