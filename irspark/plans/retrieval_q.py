"""Registered queries: BM25 variants, pair scoring, candidates, TF-IDF, sparse BM25
weights, the (k1, b) grid, two-field BM25, and exact vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import round6
from ..functions import text as T
from ..functions.vectors import l2_norm, l2_normalize
from ..operators import lexical as lx
from ..operators import vector as V
from ..operators.common import attach_scalars
from ..operators.evaluate import evaluate_run
from ..operators.index import build_index
from ..sources import fixtures as fx
from . import sql as S
from .registry import register
from .text_q import WS, lemma_of, lemma_rule

WS_TOK = WS.format(c="coalesce({c}, '')")


stem_tok = T.of_terms(T.tok_alnum, T.suffix_stem, T.stem_rule)


STEM = "list_transform(" + S.ALNUM + ", lambda w: regexp_replace(w, '(ing|ed|es|s)$', ''))"

# ------------------------------------------------------------------ zero fill (k > matches)
K_FILL = 500


@register("bm25_fill", f"""WITH {S.docs_tokens()}, {S.query_tokens()}, {S.INDEX.strip()}, {S.QTERMS},
{S.bm25_scores().strip()},
allp AS (SELECT qt.query_id, dl.doc_id, coalesce(s.score, 0.0) score FROM qt CROSS JOIN dl LEFT JOIN s USING (query_id, doc_id)),
{S.topk('allp', K_FILL)}
SELECT * FROM run""")
def q_bm25_fill(spark, sf):
    """k larger than the number of matching documents: the run is padded with score-0
    documents (lowest ids first) up to min(k, N) rows per query.  The oracle ranks the full
    query x document product (brute force); the Spark plan pads only short queries."""
    return lx.bm25_retrieve(fx.docs(spark, sf), fx.queries(spark, sf), K_FILL)


lemma_tok = T.of_terms(T.tok_alnum, lemma_rule, lemma_of)


LEMMA = "list_transform(" + S.ALNUM + ", lambda w: regexp_replace(regexp_replace(w, 'ies$', 'y'), '([^s])s$', '\\1'))"
VARIANTS = {"original": T.tok_alnum, "stemmed": stem_tok, "lemmatized": lemma_tok}


def _variant_sql(n: str, tok: str) -> str:
    """CTEs bm_{n} and tf_{n}: the BM25 and the TF-IDF top 10 of one collection variant."""
    return f"""d_{n} AS (SELECT CAST(doc_id AS VARCHAR) doc_id, {tok.format(c='text')} toks FROM documents),
qt_{n} AS (SELECT CAST(item_id AS VARCHAR) query_id, {tok.format(c='text')} toks FROM benchmark),
dl_{n} AS (SELECT doc_id, len(toks) dl FROM d_{n}),
p_{n} AS (SELECT doc_id, term, count(*) tf FROM (SELECT doc_id, unnest(toks) term FROM d_{n}) GROUP BY ALL),
st_{n} AS (SELECT count(*)::DOUBLE n, sum(dl)::DOUBLE / count(*) avgdl FROM dl_{n}),
df_{n} AS (SELECT term, count(*) df FROM p_{n} GROUP BY ALL),
q_{n} AS (SELECT query_id, term, count(*) qtf FROM (SELECT query_id, unnest(toks) term FROM qt_{n}) GROUP BY ALL),
raw_{n} AS (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) raw, ln((1 + n) / (1 + df)) + 1 ti FROM df_{n}, st_{n}),
idf_{n} AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raw_{n}) ELSE raw END idf, ti FROM raw_{n}),
b_{n} AS (SELECT q.query_id, p.doc_id, sum(q.qtf * i.idf * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) score
  FROM q_{n} q JOIN p_{n} p USING (term) JOIN idf_{n} i USING (term) JOIN dl_{n} USING (doc_id), st_{n} GROUP BY ALL),
dn_{n} AS (SELECT doc_id, sqrt(sum((tf * ti) ^ 2)) dn FROM p_{n} JOIN idf_{n} USING (term) GROUP BY ALL),
qn_{n} AS (SELECT query_id, sqrt(sum((qtf * ti) ^ 2)) qn FROM q_{n} JOIN idf_{n} USING (term) GROUP BY ALL),
t_{n} AS (SELECT query_id, doc_id, sum(qtf * ti * tf * ti) / (max(qn) * max(dn)) score FROM q_{n} JOIN p_{n} USING (term)
  JOIN idf_{n} USING (term) JOIN qn_{n} USING (query_id) JOIN dn_{n} USING (doc_id) GROUP BY ALL),
{S.topk(f'b_{n}', 10, f'bm_{n}')}, {S.topk(f't_{n}', 10, f'tf_{n}')}"""


_VARIANT_CTES = "WITH " + ", ".join(_variant_sql(n, t) for n, t in (("original", S.ALNUM), ("stemmed", STEM), ("lemmatized", LEMMA)))


def _variant_union(prefix: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' variant, * FROM {prefix}_{n}" for n in VARIANTS)


@register("bm25_variants", f"{_VARIANT_CTES} {_variant_union('bm')}")
def q_bm25_variants(spark, sf):
    """BM25 over the original, stemmed and lemmatized collection, queries processed alike."""
    return lx.run_variants(fx.docs(spark, sf), fx.queries(spark, sf), VARIANTS, 10)


@register("tfidf_variants", f"{_VARIANT_CTES} {_variant_union('tf')}")
def q_tfidf_variants(spark, sf):
    """TF-IDF cosine over the same three collections."""
    return lx.run_variants(fx.docs(spark, sf), fx.queries(spark, sf), VARIANTS, 10, retriever=lx.tfidf_retrieve)


# whitespace-tokenised BM25 as candidate generator
def _ws_sql(name_prefix: str, k: int) -> str:
    return f"""dw AS (SELECT CAST(doc_id AS VARCHAR) doc_id, {WS_TOK.format(c='text')} toks FROM documents),
qw AS (SELECT CAST(item_id AS VARCHAR) query_id, {WS_TOK.format(c='text')} toks FROM benchmark),
dlw AS (SELECT doc_id, len(toks) dl FROM dw),
pw AS (SELECT doc_id, term, count(*) tf FROM (SELECT doc_id, unnest(toks) term FROM dw) GROUP BY ALL),
stw AS (SELECT count(*)::DOUBLE n, sum(dl)::DOUBLE / count(*) avgdl FROM dlw),
dfw AS (SELECT term, count(*) df FROM pw GROUP BY ALL),
qqw AS (SELECT query_id, term, count(*) qtf FROM (SELECT query_id, unnest(toks) term FROM qw) GROUP BY ALL),
i0w AS (SELECT term, ln(stw.n - df + 0.5) - ln(df + 0.5) raw FROM dfw, stw),
miw AS (SELECT avg(raw) m FROM i0w),
idfw AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * m ELSE raw END idf FROM i0w, miw),
sw AS (SELECT qqw.query_id, pw.doc_id, sum(qqw.qtf * idfw.idf * pw.tf * 2.2 / (pw.tf + 1.2 * (0.25 + 0.75 * dlw.dl / stw.avgdl))) score
       FROM qqw JOIN pw USING (term) JOIN idfw USING (term) JOIN dlw USING (doc_id), stw GROUP BY ALL),
{S.topk('sw', k, name_prefix)}"""


@register("bm25_score_pairs", f"""WITH {_ws_sql('cand', 20)}, {S.docs_tokens()}, {S.query_tokens()}, {S.INDEX.strip()}, {S.QTERMS},
{S.bm25_scores().strip()}
SELECT c.query_id, c.doc_id, round(coalesce(s.score, 0.0), 6) bm25_1 FROM cand c LEFT JOIN s USING (query_id, doc_id)""")
def q_bm25_score_pairs(spark, sf):
    """Candidates from whitespace BM25, rescored with lower-cased alphanumeric BM25."""
    docs, qs = fx.docs(spark, sf), fx.queries(spark, sf)
    cand = lx.bm25_retrieve(docs, qs, 20, tokenizer=T.tok_whitespace)
    pairs = cand.join(qs.select("query_id", F.col("text").alias("query_text")), "query_id")
    return lx.bm25_score_pairs(pairs, docs).select("query_id", "doc_id", "bm25_1")


@register("bm25_candidates", f"""WITH {S.docs_tokens()}, {S.query_tokens()}, {S.INDEX.strip()}, {S.QTERMS},
{S.bm25_scores().strip()}, {S.topk('s', 20)}
SELECT r.query_id, md5(b.text) query_text_md5, r.doc_id, md5(dd.text) doc_text_md5, r.score bm25_1
FROM run r JOIN benchmark b ON CAST(b.item_id AS VARCHAR) = r.query_id JOIN documents dd ON CAST(dd.doc_id AS VARCHAR) = r.doc_id""")
def q_bm25_candidates(spark, sf):
    c = lx.bm25_candidates(fx.docs(spark, sf), fx.queries(spark, sf), 20)
    return c.select("query_id", F.md5("query_text").alias("query_text_md5"), "doc_id",
                    F.md5("doc_text").alias("doc_text_md5"), "bm25_1")


TFIDF_CTES = f"""tdw AS (SELECT CAST(doc_id AS VARCHAR) doc_id, {WS_TOK.format(c='text')} toks FROM documents),
tqw AS (SELECT CAST(item_id AS VARCHAR) query_id, {WS_TOK.format(c='text')} toks FROM benchmark),
tp AS (SELECT doc_id, term, count(*) tf FROM (SELECT doc_id, unnest(toks) term FROM tdw) GROUP BY ALL),
tn AS (SELECT count(*)::DOUBLE n FROM tdw),
tidf AS (SELECT term, ln((1 + n) / (1 + count(*))) + 1 idf FROM tp, tn GROUP BY term, n),
tdn AS (SELECT doc_id, sqrt(sum((tf * idf) ^ 2)) dnorm FROM tp JOIN tidf USING (term) GROUP BY ALL),
tq AS (SELECT query_id, term, count(*) qtf FROM (SELECT query_id, unnest(toks) term FROM tqw) GROUP BY ALL),
tqv AS (SELECT query_id, term, qtf * idf qw, idf FROM tq JOIN tidf USING (term)),
tqn AS (SELECT query_id, sqrt(sum(qw ^ 2)) qnorm FROM tqv GROUP BY ALL),
ts AS (SELECT tqv.query_id, tp.doc_id, sum(tqv.qw * tp.tf * tqv.idf) / (max(tqn.qnorm) * max(tdn.dnorm)) score
      FROM tqv JOIN tp USING (term) JOIN tqn USING (query_id) JOIN tdn USING (doc_id) GROUP BY ALL),
{S.topk('ts', 20, 'tfr')}"""


@register("tfidf_topk", f"WITH {TFIDF_CTES} SELECT * FROM tfr")
def q_tfidf_topk(spark, sf):
    return lx.tfidf_retrieve(fx.docs(spark, sf), fx.queries(spark, sf), 20, tokenizer=T.tok_whitespace)


LUCENE_WEIGHTS = """li AS (SELECT term, ln(1 + (st.n - df + 0.5) / (df + 0.5)) idf FROM df, st),
av AS (SELECT CASE WHEN avgdl > 0 THEN avgdl ELSE 1.0 END a FROM st),
w AS (SELECT p.doc_id, p.term, p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * dl.dl / av.a)) * li.idf weight
      FROM p JOIN li USING (term) JOIN dl USING (doc_id), av)"""
_LUCENE = f"{S.docs_tokens()}, {S.INDEX.strip()}, {LUCENE_WEIGHTS}"


@register("bm25_sparse_weights", f"WITH {_LUCENE} SELECT doc_id, term, round(weight, 6) weight FROM w")
def q_bm25_sparse_weights(spark, sf):
    idx = build_index(fx.docs(spark, sf))
    return lx.bm25_term_weights(idx).select("doc_id", "term", round6("weight").alias("weight"))


@register("bm25_sparse_pairs", f"""WITH {_LUCENE}, {S.query_tokens()}, {S.QTERMS},
{S.bm25_scores().strip()}, {S.topk('s', 5)}
SELECT r.query_id, r.doc_id, q.term, round(w.weight * q.qtf, 6) value
FROM run r JOIN q USING (query_id) JOIN w ON w.doc_id = r.doc_id AND w.term = q.term""")
def q_bm25_sparse_pairs(spark, sf):
    """Per (query, doc, term) Lucene-idf BM25 weight x query tf for the BM25 top-5; the doc
    weights are transformed with the vocabulary fitted on the whole corpus."""
    docs, qs = fx.docs(spark, sf), fx.queries(spark, sf)
    fitted = build_index(docs)
    c = lx.bm25_candidates(docs, qs, 5)
    return lx.bm25_pair_features(c, fitted).select("query_id", "doc_id", "term", round6("value").alias("value"))


GRID = [(k1, b) for k1 in (0.9, 1.2, 1.5) for b in (0.5, 0.75, 1.0)]
_GRID_SQL = " UNION ALL ".join(f"SELECT {k1}::DOUBLE k1, {b}::DOUBLE b" for k1, b in GRID)


_GRID_CTES = f"""WITH {S.docs_tokens()}, {S.query_tokens()}, {S.INDEX.strip()}, {S.QTERMS},
{S.QUERIES_FIX}, {S.QRELS_FIX},
idf0 AS (SELECT term, ln(st.n - df + 0.5) - ln(df + 0.5) raw FROM df, st),
mi AS (SELECT avg(raw) m FROM idf0),
idf AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * m ELSE raw END idf FROM idf0, mi),
g AS ({_GRID_SQL}),
vq AS (SELECT query_id, split FROM qs WHERE split <> 'train'),
s AS (SELECT g.k1, g.b, q.query_id, p.doc_id, sum(q.qtf * idf.idf * p.tf * (g.k1 + 1) / (p.tf + g.k1 * (1 - g.b + g.b * dl.dl / st.avgdl))) score
      FROM q JOIN vq USING (query_id) JOIN p USING (term) JOIN idf USING (term) JOIN dl USING (doc_id), st, g GROUP BY ALL),
run AS (SELECT k1, b, query_id, doc_id, score FROM (SELECT k1, b, query_id, doc_id, round(score, 6) score,
        row_number() OVER (PARTITION BY k1, b, query_id ORDER BY round(score, 6) DESC, doc_id) rk FROM s) WHERE rk <= 20),
vqr AS (SELECT qrels.*, vq.split FROM qrels JOIN vq USING (query_id)),
jr AS (SELECT r.k1, r.b, r.query_id, r.doc_id, r.score, coalesce(x.relevance, 0) rel FROM run r LEFT JOIN vqr x USING (query_id, doc_id)),
rr AS (SELECT *, row_number() OVER (PARTITION BY k1, b, query_id ORDER BY score DESC, doc_id DESC) rk FROM jr),
rq AS (SELECT k1, b, query_id, sum(CASE WHEN rk <= 20 THEN greatest(rel, 0)::DOUBLE / log2(rk + 1) ELSE 0 END) dcg FROM rr GROUP BY ALL),
iq AS (SELECT split, query_id, sum(CASE WHEN irk <= 20 THEN greatest(relevance, 0)::DOUBLE / log2(irk + 1) ELSE 0 END) idcg
       FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC) irk FROM vqr) GROUP BY ALL),
pq AS (SELECT g.k1, g.b, iq.split, iq.query_id, coalesce(rq.dcg / nullif(iq.idcg, 0), 0) ndcg FROM g CROSS JOIN iq LEFT JOIN rq ON rq.k1 = g.k1 AND rq.b = g.b AND rq.query_id = iq.query_id),
t AS (SELECT k1, b, round(avg(ndcg) FILTER (split = 'validation'), 6) v, round(avg(ndcg) FILTER (split = 'test'), 6) w FROM pq GROUP BY ALL),
top AS (SELECT * FROM t ORDER BY v DESC, k1, b LIMIT 1)"""


def _tuned(spark, sf):
    val = fx.queries(spark, sf).filter(F.col("split") == "validation")
    grid = spark.createDataFrame(GRID, "k1 double, b double")
    return lx.tune_bm25(fx.docs(spark, sf), val, fx.qrels(spark, sf), grid)


@register("bm25_grid", _GRID_CTES + ' SELECT t.k1, t.b, t.v "nDCG@20", (t.k1 = top.k1 AND t.b = top.b) best FROM t, top')
def q_bm25_grid(spark, sf):
    """nDCG@20 of every (k1, b) on the validation queries in one job; ``best`` marks the
    first best setting (ties: smallest k1, then b)."""
    k1, b, table = _tuned(spark, sf)
    return table.select("k1", "b", "`nDCG@20`", ((F.col("k1") == k1) & (F.col("b") == b)).alias("best"))


@register("bm25_grid_test", _GRID_CTES + ' SELECT k1, b, v validation, w test FROM top')
def q_bm25_grid_test(spark, sf):
    """The best setting of the validation queries, run once more on the test queries."""
    k1, b, table = _tuned(spark, sf)
    test = fx.queries(spark, sf).filter(F.col("split") == "test")
    run = lx.bm25_retrieve(fx.docs(spark, sf), test, 20, k1=k1, b=b)
    qrels = fx.qrels(spark, sf).join(test.select("query_id"), "query_id", "left_semi")
    t = evaluate_run(run, qrels, ["nDCG@20"]).select(round6(F.col("`nDCG@20`")).alias("test"))
    best = table.filter((F.col("k1") == k1) & (F.col("b") == b))
    return attach_scalars(best.select("k1", "b", F.col("`nDCG@20`").alias("validation")), t)


_FIELD = """{n}_d AS (SELECT CAST(doc_id AS VARCHAR) doc_id, {tok} toks FROM documents),
{n}_dl AS (SELECT doc_id, len(toks) dl FROM {n}_d),
{n}_p AS (SELECT doc_id, term, count(*) tf FROM (SELECT doc_id, unnest(toks) term FROM {n}_d) GROUP BY ALL),
{n}_st AS (SELECT count(*)::DOUBLE n, sum(dl)::DOUBLE / count(*) avgdl FROM {n}_dl),
{n}_df AS (SELECT term, count(*) df FROM {n}_p GROUP BY ALL),
{n}_i0 AS (SELECT term, ln({n}_st.n - df + 0.5) - ln(df + 0.5) raw FROM {n}_df, {n}_st),
{n}_mi AS (SELECT avg(raw) m FROM {n}_i0),
{n}_idf AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * m ELSE raw END idf FROM {n}_i0, {n}_mi),
{n}_s AS (SELECT q.query_id, p.doc_id, {w}::DOUBLE * q.qtf * i.idf * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * l.dl / st.avgdl)) c
       FROM q JOIN {n}_p p USING (term) JOIN {n}_idf i USING (term) JOIN {n}_dl l USING (doc_id), {n}_st st)"""
TITLE_SQL = "regexp_extract_all(lower(split_part(coalesce(text, ''), chr(10), 1)), '[a-z0-9]+')"
BODY_SQL = "regexp_extract_all(lower(coalesce(text[length(split_part(coalesce(text, ''), chr(10), 1)) + 2:], '')), '[a-z0-9]+')"


@register("two_field_bm25", f"""WITH {S.query_tokens()}, {S.QTERMS},
{_FIELD.format(n='ti', tok=TITLE_SQL, w=2.0)},
{_FIELD.format(n='bo', tok=BODY_SQL, w=1.0)},
s AS (SELECT query_id, doc_id, sum(c) score FROM (SELECT * FROM ti_s UNION ALL SELECT * FROM bo_s) GROUP BY ALL),
{S.topk('s', 10)}
SELECT * FROM run""")
def q_two_field_bm25(spark, sf):
    """Passage = title (first line) + body (the rest); per-field BM25 with its own df, N and
    avgdl, weighted 2:1."""
    d = fx.docs(spark, sf)
    first = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", 2)
    d = d.select("doc_id", first.getItem(0).alias("title"), F.coalesce(F.get(first, 1), F.lit("")).alias("body"))
    return lx.bm25_fields(d, fx.queries(spark, sf), {"title": "title", "body": "body"}, {"title": 2.0, "body": 1.0}, 10)


# -------------------------------------------------------------------------------- vectors
VQ = "vq AS (SELECT CAST(vec_id AS VARCHAR) query_id, embedding::DOUBLE[] e FROM embeddings WHERE vec_id IN (SELECT item_id FROM benchmark))"
VD = "vd AS (SELECT CAST(vec_id AS VARCHAR) doc_id, embedding::DOUBLE[] e, label FROM embeddings WHERE vec_id NOT IN (SELECT item_id FROM benchmark))"


def vector_run(spark, sf, k=20, where=None):
    q = fx.vector_queries(spark, sf).withColumnRenamed("item_id", "query_id")
    return V.vector_retrieve(q, fx.vector_docs(spark, sf), k, where=where)


@register("vector_topk", f"""WITH {VQ}, {VD}, vs AS (SELECT query_id, doc_id, list_cosine_similarity(vq.e, vd.e) score FROM vq, vd),
{S.topk('vs', 10)} SELECT * FROM run""")
def q_vector_topk(spark, sf):
    return vector_run(spark, sf, 10)


@register("vector_topk_filtered", f"""WITH {VQ}, {VD}, vs AS (SELECT query_id, doc_id, list_cosine_similarity(vq.e, vd.e) score FROM vq, vd WHERE label < 5),
{S.topk('vs', 10)} SELECT * FROM run""")
def q_vector_topk_filtered(spark, sf):
    return vector_run(spark, sf, 10, where=F.col("label") < 5)


@register("l2_normalize", """SELECT CAST(vec_id AS VARCHAR) item_id, round(sqrt(list_sum(list_transform(n, lambda x: x * x))), 6) norm,
  round(list_sum(n), 6) total FROM (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y)))) n FROM embeddings)""")
def q_l2_normalize(spark, sf):
    v = fx.vectors(spark, sf).select("item_id", l2_normalize("embedding").alias("n"))
    return v.select("item_id", round6(l2_norm("n")).alias("norm"),
                    round6(F.aggregate("n", F.lit(0.0), lambda a, x: a + x)).alias("total"))


@register("embed_texts")
def q_embed_texts(spark, sf):
    """Spark-trained Word2Vec document vectors (unit length); rows-only check."""
    _, v = V.embed_texts(fx.docs(spark, sf))
    return v.select("doc_id", F.size("embedding").alias("dim"), round6(l2_norm("embedding")).alias("norm"))


_PARA_SQL = """WITH pr AS (SELECT CAST(doc_id AS VARCHAR) doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) p,
  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) pos FROM documents),
pk AS (SELECT doc_id || '_' || row_number() OVER (PARTITION BY doc_id ORDER BY pos) para_id, source, p FROM pr WHERE trim(p) <> ''),
tk AS (SELECT para_id, source, regexp_extract_all(lower(p), '[a-z0-9]+') toks FROM pk),
po AS (SELECT para_id, term, count(*) tf FROM (SELECT para_id, unnest(toks) term FROM tk) GROUP BY ALL),
n AS (SELECT count(*)::DOUBLE n FROM tk),
df AS (SELECT term, count(*) df FROM po GROUP BY ALL),
idf AS (SELECT term, df, ln((1 + n) / (1 + df)) + 1 idf FROM df, n),
nr AS (SELECT para_id, sqrt(sum((tf * idf) ^ 2)) dn FROM po JOIN idf USING (term) GROUP BY ALL),
w AS (SELECT po.para_id, po.term, tf * idf / dn w, tk.source FROM po JOIN idf USING (term) JOIN nr USING (para_id) JOIN tk USING (para_id)),
s AS (SELECT a.para_id para_a, b.para_id para_b, round(sum(a.w * b.w), 6) score FROM w a JOIN w b ON a.term = b.term
      WHERE a.para_id <> b.para_id AND a.source {op} b.source GROUP BY ALL)
SELECT para_a, para_b, score, CAST(rank AS INTEGER) rank FROM (SELECT *, row_number() OVER (PARTITION BY para_a ORDER BY score DESC, para_b) rank FROM s) WHERE rank <= 3"""


def _similar_paragraphs(spark, sf, scope):
    from ..sources.io import split_paragraphs

    paras = split_paragraphs(fx.docs(spark, sf), sep="\n").join(fx.docs(spark, sf).select("doc_id", "source"), "doc_id")
    out = lx.similar_pairs(paras, k=3, group_col="source", scope=scope)
    return out.select("para_a", "para_b", "score", F.col("rank").cast("int").alias("rank"))


@register("paragraph_similarity", _PARA_SQL.format(op="="))
def q_paragraph_similarity(spark, sf):
    """Top-3 most similar paragraphs (split on lines) of the same source, TF-IDF cosine over all terms."""
    return _similar_paragraphs(spark, sf, "within")


@register("paragraph_similarity_across", _PARA_SQL.format(op="<>"))
def q_paragraph_similarity_across(spark, sf):
    """The same between paragraphs of different sources."""
    return _similar_paragraphs(spark, sf, "across")
