"""Registered queries of the training-data operators, with SQL where DuckDB can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import render_chats
from .decontaminate import decontaminate
from .embeddings import embedding_dedup
from .histogram_sort import histogram_shards
from .labelled import crc_of_id
from .maxent import maxent_score
from .mixing import mix_to_targets
from .ngram_join import ngram_jaccard_join
from .ns_bounds import ns_cluster
from .quality import quality
from .rlz_dedup import rlz_dedup
from .suffix_dedup import suffix_array_dedup
from .term_audit import term_audit
from .toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query("op3_rlz_dedup")
def op3(spark, sf_dir):
    out = rlz_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op5_suffix_array_dedup")
def op5(spark, sf_dir):
    out = suffix_array_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_quality_fm")
def op4(spark, sf_dir):
    held = F.pmod(crc_of_id(), F.lit(3)) == 1
    out = quality(table(spark, sf_dir, "documents", "doc_id", "text"),
                  table(spark, sf_dir, "labels", "doc_id", "quality"), ~held)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op10_toxicity_nb_linear")
def op10(spark, sf_dir):
    held = F.pmod(crc_of_id(), F.lit(5)) == 0
    out = toxicity(table(spark, sf_dir, "documents", "doc_id", "text"),
                   table(spark, sf_dir, "labels", "doc_id", "toxic"), ~held)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op9_decontaminate", r"""
WITH words_of AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
starts AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words_of, sizes WHERE len(w) >= n)),
hits AS (SELECT rid, s.n, i, item FROM starts s JOIN windows USING (n, win)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words_of LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)""")
def op9(spark, sf_dir):
    out = decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"),
                        table(spark, sf_dir, "benchmark", "item_id", "text"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op7_ngram_jaccard_join")
def op7(spark, sf_dir):
    return ngram_jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op1_maxent_score")
def op1(spark, sf_dir):
    return maxent_score(table(spark, sf_dir, "documents", "doc_id", "text"), F.pmod(crc_of_id(), F.lit(5)) == 1)


@query("op2_collapse_chats", r"""
WITH t AS (
  SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
one AS (SELECT conv_id, turn, string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ORDER BY role, text) AS s
        FROM t GROUP BY conv_id, turn),
pre AS (
  SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last,
         string_agg(turn || '=' || s, '') OVER (PARTITION BY conv_id ORDER BY turn) AS p
  FROM one),
whole AS (SELECT min(conv_id) AS conv_id, count(*) AS copies, turn, p FROM pre WHERE turn = last GROUP BY turn, p),
keep AS (SELECT conv_id, copies FROM whole w
         WHERE NOT EXISTS (SELECT 1 FROM pre WHERE pre.turn = w.turn AND pre.p = w.p AND pre.last > pre.turn))
SELECT conv_id, CAST(greatest(turn, 0) // 1024 AS BIGINT) AS part, CAST(copies AS BIGINT) AS copies,
       CAST(count(*) AS BIGINT) AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
FROM t JOIN keep USING (conv_id) GROUP BY ALL""")
def op2(spark, sf_dir):
    return render_chats(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@query("op6_mix_to_targets")
def op6(spark, sf_dir):
    out = mix_to_targets(table(spark, sf_dir, "documents", "doc_id", "text"),
                         table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return out.select("doc_id", "n_tokens", "posterior", "rate", "expected", "target")


@query("op8_embedding_dedup")
def op8(spark, sf_dir):
    return embedding_dedup(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query("op11_histogram_shards")
def op11(spark, sf_dir):
    out = histogram_shards(table(spark, sf_dir, "documents", "doc_id", "text"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return out.select("doc_id", "size", crc.alias("text_crc32"), "law", "shard", "slot", "grown_shard")


def lloyd_sql(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2) -> str:
    """Plain Lloyd rounds, unrolled: every distance in each round."""
    near = """a{r} AS MATERIALIZED (
  SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT rid, c, CAST(list_sum(list_transform(list_zip(x.v, m{r}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
        FROM x, m{r}) GROUP BY rid)"""
    mean = """m{r} AS MATERIALIZED (
  SELECT c, coalesce(u.v, o.v) AS v
  FROM m{p} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
    FROM (SELECT c, i, sum(e) AS s, count(*) AS n
          FROM (SELECT c, unnest(v) AS e, unnest(range(len(v))) AS i FROM x JOIN a{p} USING (rid)) GROUP BY c, i)
    GROUP BY c) u USING (c))"""
    parts = [f"""x AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, embedding,
         list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dims})""",
             f"""m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, embedding) - 1 AS c, v
  FROM (SELECT sha256('{seed}:' || vec_id) AS h, embedding, v FROM x ORDER BY h NULLS LAST, embedding LIMIT {k}))""",
             near.format(r=0)]
    for r in range(1, rounds + 1):
        parts += [mean.format(r=r, p=r - 1), near.format(r=r)]
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m{rounds}.v, ',')) AS centroid_sha256
FROM x JOIN a{rounds} USING (rid) JOIN m{rounds} USING (c)"""


@query("op13_ns_bounds_clusters", lloyd_sql())
def op13(spark, sf_dir):
    out = ns_cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(F.col("centroid").cast("binary"), 256).alias("centroid_sha256"))


@query("op12_term_audit", r"""
WITH t AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM t),
u AS MATERIALIZED (SELECT rid, lang, source, term, count(*) AS n
                   FROM (SELECT rid, lang, source, unnest(w) AS term FROM t) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM u GROUP BY lang, term HAVING count(*) >= 3),
l AS MATERIALIZED (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, term, CAST(sum(u.n) AS HUGEINT) AS n FROM u JOIN k USING (lang, term) GROUP BY ALL),
s AS MATERIALIZED (SELECT lang, source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS MATERIALIZED (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (s.total + l.v) AS p,
         1 + (1000000000 * (k.n + 1)) // (l.total + l.v) AS q
  FROM s JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS f
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) z
  ON z.lang = a.lang AND z.source = a.source AND z.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, CAST(value AS BIGINT),
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms
QUALIFY rank <= 200""")
def op12(spark, sf_dir):
    return term_audit(table(spark, sf_dir, "documents", "lang", "source", "text"))
