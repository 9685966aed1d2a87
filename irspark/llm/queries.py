"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import os
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import centroid_clusters
from .decontam import contaminated
from .exact_dedup import exact_dedup
from .frames import cut, remainder
from .langid import language_mixtures, train_languages
from .packing import pack_windows, token_pieces
from .pieces import encode_pieces
from .prefix_trie import prefix_trie, shared_heads, turn_arrays
from .quality import document_statistics, quality_scores, train_quality
from .secrets import ACCESS, ASSIGN, ENDPOINT, HEX, WEAK_ACCESS, WEAK_SECRET, secret_scan
from .sharding import shard_documents
from .simhash import simhash_dedup
from .suffix_tree import suffix_tree_scores, train_suffix_tree
from .toxicity import toxicity_scores, train_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op3_contamination", f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
dp AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0),
bp AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM b WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM dp),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM bp),
n AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS c FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS item_shingles, CAST(c AS INTEGER) AS shared_shingles,
       CAST(c AS DOUBLE) / n AS containment
FROM m JOIN n USING (item_id) WHERE c >= ceil(0.8 * n - 1e-9)""")
def op3_contamination(spark, sf_dir):
    """Pairs of a document and a benchmark item it contains: containment of 5-word shingles >= 0.8."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op5_exact_dedup", f"""
WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)""")
def op5_exact_dedup(spark, sf_dir):
    """Every document with the row of its equal texts that stays."""
    return exact_dedup(table(spark, sf_dir, "documents"))


@register("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    """Toxicity score of every document; labels of the rows held out teach nothing."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = remainder("doc_id", 5) == 0
    model = train_toxicity(docs, labels.where(~held))
    return toxicity_scores(docs, model).select("doc_id", held.alias("held_out"), "score",
                                               (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op7_pieces")
def op7_pieces(spark, sf_dir):
    """Pieces of every document and whether decoding gives its text back."""
    return encode_pieces(table(spark, sf_dir, "documents"))


@register("op8_simhash")
def op8_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    return simhash_dedup(table(spark, sf_dir, "documents"))


@register("op1_balanced_shards")
def op1_balanced_shards(spark, sf_dir):
    """16 shards with row counts at most one apart, equal texts together."""
    return shard_documents(table(spark, sf_dir, "documents"))


def _span_sql(kind: str, rank: int, pattern: str, keep: str) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS r, s, s + length(hit) AS e FROM (
  SELECT doc_id, m[i] AS hit, v[i] AS val, length(array_to_string(g[1:i], '')) + length(array_to_string(m[1:i - 1], '')) AS s
  FROM (SELECT doc_id, m, v, g, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {1 if kind == 'assign' else 0}) AS v,
           string_split_regex(t, '{p}') AS g FROM docs))) WHERE {keep}"""


_NEAR = "p.doc_id = x.doc_id AND p.s <= x.e + 200 AND p.e >= x.s - 200"
_SECRETS_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS ({_span_sql('assign', 0, ASSIGN, 'length(val) >= 8')} UNION ALL {_span_sql('access', 1, ACCESS, 'length(hit) >= 16')}
  UNION ALL {_span_sql('hex', 2, HEX, 'true')}),
weak AS (SELECT * FROM ({_span_sql('weak_secret', 3, WEAK_SECRET, 'length(hit) = 40')} UNION ALL
  {_span_sql('weak_access', 4, WEAK_ACCESS, 'length(hit) BETWEEN 8 AND 40')} UNION ALL {_span_sql('endpoint', 5, ENDPOINT, 'true')}) AS w
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.s <= w.s AND w.e <= b.e)),
parts AS (SELECT *, CASE WHEN kind IN ('access', 'weak_access') THEN 'id' WHEN kind = 'endpoint' THEN 'endpoint'
  ELSE 'secret' END AS role FROM (SELECT * FROM base UNION ALL SELECT * FROM weak)),
linked AS (SELECT * EXCLUDE (role) FROM parts x WHERE r > 2
  AND (role = 'id' OR EXISTS (SELECT 1 FROM parts p WHERE {_NEAR} AND p.role = 'id'))
  AND (role = 'secret' OR EXISTS (SELECT 1 FROM parts p WHERE {_NEAR} AND p.role = 'secret'))),
b AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r, e) AS l FROM base GROUP BY 1),
a AS (SELECT doc_id, count(*) FILTER (r > 2) AS n_linked, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r, e) AS l
  FROM (SELECT * FROM base UNION ALL SELECT * FROM linked) GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b.l, '')) AS base_sha256, coalesce(a.l, '') AS spans, coalesce(n_linked, 0) AS n_linked
FROM docs LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)"""


@register("op10_secrets", _SECRETS_SQL)
def op10_secrets(spark, sf_dir):
    """Secrets of every document, weak parts only where complementary parts stand near."""
    return secret_scan(table(spark, sf_dir, "documents"))


@register("op2_language_mixture")
def op2_language_mixture(spark, sf_dir):
    """Language of every document by mixture inference; every third id teaches nothing."""
    docs = table(spark, sf_dir, "documents")
    held = remainder("doc_id", 3) == 1
    found = language_mixtures(docs, train_languages(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "languages", "shares")


@register("op9_quality")
def op9_quality(spark, sf_dir):
    """Quality score of every document; labels of the rows held out teach nothing."""
    held = remainder("doc_id", 5) == 0
    stats = cut(document_statistics(table(spark, sf_dir, "documents")))
    model = train_quality(stats, table(spark, sf_dir, "labels").where(~held))
    return quality_scores(stats, model).select("doc_id", held.alias("held_out"), "score",
                                               (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op4_suffix_tree")
def op4_suffix_tree(spark, sf_dir):
    """Log probability of every document under the suffix tree; every seventh id teaches nothing."""
    docs = table(spark, sf_dir, "documents")
    held = remainder("doc_id", 7) == 2
    model, words = train_suffix_tree(docs.where(~held))
    return suffix_tree_scores(docs, model, words).select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op11_packing")
def op11_packing(spark, sf_dir):
    """Pieces of every document in sequences of 2048 tokens, best fit decreasing."""
    pieces = token_pieces(table(spark, sf_dir, "documents"))
    return pack_windows(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


def _clusters_sql(clusters: int = 16, rounds: int = 3, components: int = 64, scale: int = 64) -> str:
    ctes = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = {components} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {components})""",
            f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, q FROM (
  SELECT sha256('1:' || vec_id) AS h, q FROM kept ORDER BY h LIMIT {clusters}))"""]
    for t in range(rounds + 1):
        ctes.append(f"""a{t} AS MATERIALIZED (SELECT r, vec_id, q, c, d FROM (
  SELECT r, vec_id, k.q, c, list_sum(list_transform(range(1, {components + 1}), lambda i: (k.q[i] - z.q[i]) * (k.q[i] - z.q[i]))) AS d
  FROM kept k CROSS JOIN c{t} z) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if t < rounds:
            ctes.append(f"""c{t + 1} AS MATERIALIZED (SELECT c, coalesce(m.q, o.q) AS q FROM c{t} o LEFT JOIN (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM (
    SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
      SELECT c, unnest(q) AS x, unnest(range({components})) AS i FROM a{t}) GROUP BY c, i) GROUP BY c) m USING (c))""")
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(z.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} z USING (c)"""


@register("op12_centroids", _clusters_sql())
def op12_centroids(spark, sf_dir):
    """Cluster of every kept vector after three rounds over 16 centroids."""
    found = centroid_clusters(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


# CRC-32 bit by bit: a list of the bytes, each followed by eight steps (-1); 3988292384 is its polynomial
_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda s: [CAST(ascii(s) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""


@register("op13_prefix_trie", f"""
WITH t AS (SELECT conv_id, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} AS v,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(v ORDER BY k) AS l FROM t GROUP BY conv_id),
h AS (SELECT conv_id, l, {_CRC} % 6 AS h FROM own),
f AS (SELECT h.conv_id, list_concat(coalesce(b.l, [])[1:h.h], h.l[h.h + 1:]) AS l FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, len(l) = d AS e, d, l[1:d] AS p FROM (SELECT conv_id, l, unnest(range(len(l) + 1)) AS d FROM f)),
n AS (SELECT d, p, min(conv_id) AS conv_id, count(*) AS n,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (e), '')) AS s FROM p GROUP BY d, p),
c AS (SELECT p[1:d - 1] AS p, count(*) AS c FROM n WHERE d > 0 GROUP BY 1),
g AS (SELECT n.*, coalesce(c.c, 0) AS c, CASE WHEN d > 0 THEN (n.n - 1) * length(n.p[d].x) ELSE 0 END AS saved FROM n LEFT JOIN c ON c.p = n.p),
a AS (SELECT p[1:i] AS p, sum(CASE WHEN c = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
  FROM (SELECT p, c, saved, unnest(range(d + 1)) AS i FROM g) GROUP BY 1)
SELECT g.conv_id, g.d AS depth, u.conv_id AS parent_conv_id, g.n AS n_convs, g.c AS n_children, CAST(a.leaves AS BIGINT) AS n_leaves,
  CAST(a.saved AS BIGINT) AS saved_tokens, g.s AS ends_sha256
FROM g JOIN a ON a.p = g.p LEFT JOIN n u ON g.d > 0 AND u.d = g.d - 1 AND u.p = g.p[1:g.d - 1]""")
def op13_prefix_trie(spark, sf_dir):
    """Every node of the trie of the conversations, rebuilt with shared first turns."""
    return prefix_trie(shared_heads(turn_arrays(table(spark, sf_dir, "conversations"))))
