"""Registered queries: min-max, alpha mixing and tuning, re-ranking, QA contexts, split
evaluation and summaries.  Hybrid fixture: query i = benchmark item i = vector i, every item."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import round6
from ..functions import text as T
from ..operators import fuse as FU
from ..operators import lexical as lx
from ..operators.common import attach_scalars
from ..operators.evaluate import evaluate_run
from ..operators.sets import concat_splits
from ..pipelines import hybrid_experiment, lexical_experiment
from ..sources import fixtures as fx
from . import sql as S
from .registry import register
from .retrieval_q import TFIDF_CTES, VD, VQ, WS_TOK, _ws_sql, vector_run

HQ = "qt AS (SELECT CAST(item_id AS VARCHAR) query_id, " + S.ALNUM.format(c="text") + " toks FROM benchmark)"
BM25H = f"""{S.docs_tokens()}, {HQ}, {S.INDEX.strip()}, {S.QTERMS}, {S.bm25_scores().strip()}, {S.topk('s', 20, 'bm')},
{VQ}, {VD}, vs AS (SELECT query_id, doc_id, list_cosine_similarity(vq.e, vd.e) score FROM vq, vd), {S.topk('vs', 20, 'vr')},
mm AS (SELECT query_id, min(score) mn, max(score) mx FROM bm GROUP BY ALL),
bn AS (SELECT bm.query_id, bm.doc_id, CASE WHEN mx = mn THEN 0.0 ELSE (score - mn) / (mx - mn) END bm25_norm FROM bm JOIN mm USING (query_id)),
fo AS (SELECT coalesce(bn.query_id, vr.query_id) query_id, coalesce(bn.doc_id, vr.doc_id) doc_id,
        coalesce(bn.bm25_norm, 0.0) bn, coalesce(vr.score, 0.0) vs FROM bn FULL OUTER JOIN vr USING (query_id, doc_id)),
vqrels AS (SELECT CAST(q.vec_id AS VARCHAR) query_id, CAST(d.vec_id AS VARCHAR) doc_id,
        CASE WHEN q.vec_id % 2 = d.vec_id % 2 THEN 2 ELSE 1 END relevance
        FROM embeddings q JOIN embeddings d ON q.label = d.label
        WHERE q.vec_id IN (SELECT item_id FROM benchmark) AND d.vec_id NOT IN (SELECT item_id FROM benchmark))"""


def bm25_hybrid(spark, sf):
    return lx.bm25_retrieve(fx.docs(spark, sf), fx.queries(spark, sf), 20)


@register("minmax_by_query", f"WITH {BM25H} SELECT query_id, doc_id, round(bm25_norm, 6) norm FROM bn")
def q_minmax_by_query(spark, sf):
    return FU.minmax_by_query(bm25_hybrid(spark, sf)).select("query_id", "doc_id", round6("norm").alias("norm"))


@register("mix_runs", f"WITH {BM25H} SELECT query_id, doc_id, round(0.5 * bn + 0.5 * vs, 7) score FROM fo")
def q_mix_runs(spark, sf):
    m = FU.mix_runs(bm25_hybrid(spark, sf), vector_run(spark, sf, 20), 0.5)
    # half of a 6-digit score has 7 digits: reported in full, so that no tie is rounded
    return m.select("query_id", "doc_id", F.round("score", 7).alias("score"))


_ALPHAS = """al AS (SELECT i * 0.05::DOUBLE alpha FROM range(21) t(i)),
mx AS (SELECT alpha, query_id, doc_id, alpha * bn + (1 - alpha) * vs score FROM fo, al),
jr AS (SELECT m.alpha, m.query_id, m.doc_id, m.score, coalesce(q.relevance, 0) rel FROM mx m LEFT JOIN vqrels q USING (query_id, doc_id)),
rr AS (SELECT *, row_number() OVER (PARTITION BY alpha, query_id ORDER BY score DESC, doc_id DESC) rk FROM jr),
rq AS (SELECT alpha, query_id, sum(CASE WHEN rk <= 20 THEN greatest(rel, 0)::DOUBLE / log2(rk + 1) ELSE 0 END) dcg FROM rr GROUP BY ALL),
iq AS (SELECT query_id, sum(CASE WHEN irk <= 20 THEN greatest(relevance, 0)::DOUBLE / log2(irk + 1) ELSE 0 END) idcg
       FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC) irk FROM vqrels) GROUP BY ALL),
pq AS (SELECT al.alpha, iq.query_id, coalesce(rq.dcg / nullif(iq.idcg, 0), 0) ndcg FROM al CROSS JOIN iq LEFT JOIN rq ON rq.alpha = al.alpha AND rq.query_id = iq.query_id),
t AS (SELECT alpha, avg(ndcg) v FROM pq {of} GROUP BY ALL)"""


@register("tune_alpha", f"WITH {BM25H}, " + _ALPHAS.format(of="") + """
SELECT round(alpha, 6) alpha, round(v, 6) "nDCG@20", alpha = (SELECT arg_min(alpha, (-round(v, 6), alpha)) FROM t) best FROM t""")
def q_tune_alpha(spark, sf):
    """nDCG@20 of alpha * minmax(BM25) + (1 - alpha) * cosine for the 21-point grid, one job;
    ``best`` is the first (smallest) alpha reaching the maximum."""
    best, table = FU.tune_alpha(bm25_hybrid(spark, sf), vector_run(spark, sf, 20), fx.vector_qrels(spark, sf))
    return (attach_scalars(table, best.select(F.col("alpha").alias("b_alpha")))
            .select(round6("alpha").alias("alpha"), round6(F.col("`nDCG@20`")).alias("nDCG@20"),
                    (F.col("alpha") == F.col("b_alpha")).alias("best")))


def scorer():
    """Expression scorer: share of distinct query terms present in the document."""
    q, d = T.tok_alnum(F.col("query_text")), T.tok_alnum(F.col("doc_text"))
    return F.size(F.array_intersect(q, d)).cast("double") / F.size(F.array_distinct(q))


SCORER_SQL = ("len(list_intersect(regexp_extract_all(lower(b.text), '[a-z0-9]+'), regexp_extract_all(lower(dd.text), '[a-z0-9]+')))::DOUBLE"
              " / len(list_distinct(regexp_extract_all(lower(b.text), '[a-z0-9]+')))")
BM25_ALL = f"""{S.docs_tokens()}, {S.query_tokens()}, {S.INDEX.strip()}, {S.QTERMS}, {S.bm25_scores().strip()}, {S.topk('s', 20)}"""


def _rerank_ctes(k: int, x: str = "") -> str:
    """CTEs pos{x}, hr{x} (rescored slice ranked) and rest{x} (remainder) for depth k."""
    return f"""pos{x} AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) p FROM run),
head{x} AS (SELECT pos{x}.query_id, pos{x}.doc_id, round({SCORER_SQL}, 6) score, 'reranked' stage FROM pos{x}
         JOIN benchmark b ON CAST(b.item_id AS VARCHAR) = pos{x}.query_id JOIN documents dd ON CAST(dd.doc_id AS VARCHAR) = pos{x}.doc_id WHERE p <= {k}),
hr{x} AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) rank FROM head{x}),
nh{x} AS (SELECT query_id, count(*) c FROM head{x} GROUP BY ALL),
rest{x} AS (SELECT pos{x}.query_id, pos{x}.doc_id, round(score, 6) score, 'kept' stage, CAST(coalesce(c, 0) + p - {k} AS INTEGER) rank
         FROM pos{x} LEFT JOIN nh{x} USING (query_id) WHERE p > {k})"""


def _rerank(spark, sf, k):
    docs, qs = fx.docs(spark, sf), fx.queries(spark, sf)
    run = lx.bm25_retrieve(docs, qs, 20)
    out = FU.rerank_run(run, qs, docs, scorer(), k)
    return out.select("query_id", "doc_id", "score", "stage", F.col("rank").cast("int").alias("rank"))


@register("rerank_topk", f"WITH {BM25_ALL}, {_rerank_ctes(10)} SELECT * FROM hr UNION ALL SELECT * FROM rest")
def q_rerank_topk(spark, sf):
    return _rerank(spark, sf, 10)


@register("rerank_depths", f"""WITH {BM25_ALL}, {_rerank_ctes(5, '5')}, {_rerank_ctes(10, '10')}
SELECT 5 depth, * FROM hr5 UNION ALL SELECT 5, * FROM rest5 UNION ALL SELECT 10, * FROM hr10 UNION ALL SELECT 10, * FROM rest10""")
def q_rerank_depths(spark, sf):
    docs, qs = fx.docs(spark, sf), fx.queries(spark, sf)
    run = lx.bm25_retrieve(docs, qs, 20)
    outs = [FU.rerank_run(run, qs, docs, scorer(), k).withColumn("depth", F.lit(k)) for k in (5, 10)]
    return outs[0].unionByName(outs[1]).select("depth", "query_id", "doc_id", "score", "stage", F.col("rank").cast("int").alias("rank"))


@register("rerank_by_scores", f"""WITH {BM25_ALL},
sc AS (SELECT r.query_id, r.doc_id, round({SCORER_SQL}, 6) f FROM run r
       JOIN benchmark b ON CAST(b.item_id AS VARCHAR) = r.query_id JOIN documents dd ON CAST(dd.doc_id AS VARCHAR) = r.doc_id)
SELECT query_id, doc_id, f, CAST(rank AS INTEGER) rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY f DESC, doc_id) rank FROM sc) WHERE rank <= 5""")
def q_rerank_by_scores(spark, sf):
    c = lx.bm25_candidates(fx.docs(spark, sf), fx.queries(spark, sf), 20).withColumn("f", round6(scorer()))
    return FU.rerank_candidates(c, "f", 5).select("query_id", "doc_id", "f", F.col("rank").cast("int").alias("rank"))


_CTX = f"""WITH {BM25_ALL}, {S.QRELS_FIX},
pos AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) p FROM run),
parts AS (SELECT 'top1' mode, query_id, doc_id, p FROM pos WHERE p <= 1
          UNION ALL SELECT 'top5', query_id, doc_id, p FROM pos WHERE p <= 5
          UNION ALL SELECT 'oracle', query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) FROM qrels
          UNION ALL SELECT 'mixed', query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY src, p, doc_id)
            FROM (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY src) again
                  FROM (SELECT 0 src, query_id, doc_id, 0 p FROM qrels UNION ALL SELECT 1, query_id, doc_id, p FROM pos WHERE p <= 5)) WHERE again = 1),
c AS (SELECT mode, query_id, count(*) n, string_agg(dd.text, chr(10) || chr(10) ORDER BY p, parts.doc_id) ctx
      FROM parts JOIN documents dd ON CAST(dd.doc_id AS VARCHAR) = parts.doc_id GROUP BY ALL)
SELECT query_id, mode, CAST(n AS INTEGER) n_passages, md5(ctx) context_md5 FROM c"""


@register("build_context", _CTX)
def q_build_context(spark, sf):
    docs, qs = fx.docs(spark, sf), fx.queries(spark, sf)
    run = lx.bm25_retrieve(docs, qs, 20)
    a = FU.build_context(run, docs, 1).withColumn("mode", F.lit("top1"))
    b = FU.build_context(run, docs, 5).withColumn("mode", F.lit("top5"))
    c = FU.build_context(run, docs, 0, mode="oracle", qrels=fx.qrels(spark, sf))
    m = FU.build_context(run, docs, 5, mode="mixed", qrels=fx.qrels(spark, sf))
    out = a.unionByName(b).unionByName(c).unionByName(m)
    return out.select("query_id", "mode", "n_passages", F.md5("context").alias("context_md5"))


# ------------------------------------------------------------------ evaluation by split
def _eval_cols(names):
    return ", ".join(f'round(avg("{n}"), 6) "{n}"' for n in names)


_ALL = ["P@1", "P@10", "P@20", "AP@20", "nDCG@20"]
_SPLITS = f"""qs AS (SELECT CAST(item_id AS VARCHAR) query_id, CASE WHEN item_id % 10 < 6 THEN 'train' WHEN item_id % 10 < 8 THEN 'validation' ELSE 'test' END split FROM benchmark),
ba AS (@weight@), run AS (SELECT query_id, doc_id, a * bn + (1 - a) * vs score FROM fo, ba), {_rerank_ctes(10)},
runs AS (SELECT 'bm25' run_name, * FROM bm UNION ALL SELECT 'vector', * FROM vr UNION ALL SELECT 'mixed', * FROM run
  UNION ALL SELECT 'reranked', query_id, doc_id, -rank::DOUBLE FROM (SELECT * FROM hr UNION ALL SELECT * FROM rest)),
sr AS (SELECT qs.split, runs.* FROM runs JOIN qs USING (query_id)),
sq AS (SELECT qs.split, vqrels.* FROM vqrels JOIN qs USING (query_id)),
jr AS (SELECT r.split, r.run_name, r.query_id, r.doc_id, r.score, coalesce(q.relevance, 0) rel, CASE WHEN coalesce(q.relevance, 0) >= 1 THEN 1 ELSE 0 END isrel
       FROM sr r LEFT JOIN sq q USING (split, query_id, doc_id)),
rr AS (SELECT *, row_number() OVER (PARTITION BY split, run_name, query_id ORDER BY score DESC, doc_id DESC) rk,
        sum(isrel) OVER (PARTITION BY split, run_name, query_id ORDER BY score DESC, doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) cumrel FROM jr),
rq AS (SELECT split, run_name, query_id, sum(CASE WHEN rk <= 1 THEN isrel ELSE 0 END)::DOUBLE "P@1",
        sum(CASE WHEN rk <= 10 THEN isrel ELSE 0 END)::DOUBLE / 10 "P@10", sum(CASE WHEN rk <= 20 THEN isrel ELSE 0 END)::DOUBLE / 20 "P@20",
        sum(CASE WHEN rk <= 20 AND isrel = 1 THEN cumrel::DOUBLE / rk ELSE 0 END) apn,
        sum(CASE WHEN rk <= 20 THEN greatest(rel, 0)::DOUBLE / log2(rk + 1) ELSE 0 END) dcg FROM rr GROUP BY ALL),
iq AS (SELECT split, query_id, sum(CASE WHEN relevance >= 1 THEN 1 ELSE 0 END) nrel,
        sum(CASE WHEN irk <= 20 THEN greatest(relevance, 0)::DOUBLE / log2(irk + 1) ELSE 0 END) idcg
       FROM (SELECT *, row_number() OVER (PARTITION BY split, query_id ORDER BY relevance DESC) irk FROM sq) GROUP BY ALL),
rn AS (SELECT DISTINCT split, run_name FROM sr),
pq AS (SELECT rn.split, rn.run_name, iq.query_id, coalesce(rq."P@1", 0) "P@1", coalesce(rq."P@10", 0) "P@10", coalesce(rq."P@20", 0) "P@20",
        coalesce(apn / nullif(nrel, 0), 0) "AP@20", coalesce(dcg / nullif(idcg, 0), 0) "nDCG@20"
       FROM rn JOIN iq USING (split) LEFT JOIN rq ON rq.split = rn.split AND rq.run_name = rn.run_name AND rq.query_id = iq.query_id)
SELECT split, run_name, {_eval_cols(_ALL)} FROM pq GROUP BY ALL"""


@register("eval_splits", f"WITH {BM25H}, " + _SPLITS.replace("@weight@", "SELECT 0.5::DOUBLE a"))
def q_eval_splits(spark, sf):
    """(split x run) metric rows in one grouped evaluation; each split is judged with its own
    qrels; a split without qrels or queries yields no row."""
    bm = bm25_hybrid(spark, sf)
    vr = vector_run(spark, sf, 20)
    mixed = FU.mix_runs(bm, vr, 0.5)
    qs = fx.queries(spark, sf)
    reranked = FU.rerank_run(mixed, qs, fx.docs(spark, sf), scorer(), 10)
    reranked = reranked.select("query_id", "doc_id", (-F.col("rank")).cast("double").alias("score"))
    runs = concat_splits({"bm25": bm, "vector": vr, "mixed": mixed, "reranked": reranked}).withColumnRenamed("split", "run_name")
    runs = runs.join(qs.select("query_id", "split"), "query_id")
    qrels = fx.vector_qrels(spark, sf).join(qs.select("query_id", "split"), "query_id")
    t = evaluate_run(runs, qrels, _ALL, group_cols=["split", "run_name"])
    return t.select("split", "run_name", *[round6(F.col(f"`{n}`")).alias(n) for n in _ALL])


_TUNED = f"WITH {_ALPHAS.format(of='JOIN qs USING (query_id) WHERE qs.split = $$train$$')} SELECT arg_min(alpha, (-round(v, 6), alpha)) a FROM t"


@register("hybrid_experiment", f"WITH {BM25H}, " + _SPLITS.replace("@weight@", _TUNED))
def q_hybrid_experiment(spark, sf):
    """The composed experiment: BM25 and vector runs, alpha tuned on the training queries, mixed,
    re-ranked, and evaluated for each split and run."""
    done = hybrid_experiment(fx.docs(spark, sf), fx.queries(spark, sf), fx.vector_qrels(spark, sf), fx.vector_docs(spark, sf),
                             fx.vector_queries(spark, sf).withColumnRenamed("item_id", "query_id"), k=20, scorer=scorer(),
                             rerank_k=10, metrics=_ALL)
    return done.metrics.select("split", "run_name", *[round6(F.col(f"`{n}`")).alias(n) for n in _ALL])


_METHODS = f"""{S.QRELS_FIX}, {TFIDF_CTES},
runs AS (@runs@),
jr AS (SELECT r.method, r.query_id, r.doc_id, r.score, coalesce(q.relevance, 0) rel, CASE WHEN coalesce(q.relevance, 0) >= 1 THEN 1 ELSE 0 END isrel
       FROM runs r LEFT JOIN qrels q USING (query_id, doc_id)),
rr AS (SELECT *, row_number() OVER (PARTITION BY method, query_id ORDER BY score DESC, doc_id DESC) rk,
        sum(isrel) OVER (PARTITION BY method, query_id ORDER BY score DESC, doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) cumrel FROM jr),
rq AS (SELECT method, query_id, sum(CASE WHEN rk <= 1 THEN isrel ELSE 0 END)::DOUBLE "P@1",
        sum(CASE WHEN rk <= 10 THEN isrel ELSE 0 END)::DOUBLE / 10 "P@10", sum(CASE WHEN rk <= 20 THEN isrel ELSE 0 END)::DOUBLE / 20 "P@20",
        sum(CASE WHEN rk <= 20 AND isrel = 1 THEN cumrel::DOUBLE / rk ELSE 0 END) apn,
        sum(CASE WHEN rk <= 20 THEN greatest(rel, 0)::DOUBLE / log2(rk + 1) ELSE 0 END) dcg FROM rr GROUP BY ALL),
iq AS (SELECT query_id, sum(CASE WHEN relevance >= 1 THEN 1 ELSE 0 END) nrel,
        sum(CASE WHEN irk <= 20 THEN greatest(relevance, 0)::DOUBLE / log2(irk + 1) ELSE 0 END) idcg
       FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC) irk FROM qrels) GROUP BY ALL),
rn AS (SELECT DISTINCT method FROM runs),
pq AS (SELECT rn.method, iq.query_id, coalesce(rq."P@1", 0) "P@1", coalesce(rq."P@10", 0) "P@10", coalesce(rq."P@20", 0) "P@20",
        coalesce(apn / nullif(nrel, 0), 0) "AP@20", coalesce(dcg / nullif(idcg, 0), 0) "nDCG@20"
       FROM rn CROSS JOIN iq LEFT JOIN rq ON rq.method = rn.method AND rq.query_id = iq.query_id)
SELECT method, {_eval_cols(_ALL)} FROM pq GROUP BY ALL"""
_SUMMARY_SQL = f"WITH {BM25_ALL}, {_ws_sql('wsr', 20)}, " + _METHODS.replace(
    "@runs@", "SELECT 'bm25_alnum' method, * FROM run UNION ALL SELECT 'bm25_whitespace', * FROM wsr UNION ALL SELECT 'tfidf_whitespace', * FROM tfr")


@register("lexical_experiment", f"WITH {_ws_sql('wsr', 20)}, " + _METHODS.replace(
    "@runs@", "SELECT 'bm25' method, * FROM wsr UNION ALL SELECT 'tfidf', * FROM tfr").replace("SELECT method,", "SELECT method, count(*) n_queries,"))
def q_lexical_experiment(spark, sf):
    """The composed experiment: two retrievers, evaluated at the depths 1, 10 and 20, with the number
    of judged queries."""
    done = lexical_experiment(fx.docs(spark, sf), fx.queries(spark, sf), fx.qrels(spark, sf), ks=(1, 10, 20),
                              metrics=["P", "AP@20", "nDCG@20"])
    n = done.per_query.groupBy("method").agg(F.count(F.lit(1)).alias("n_queries"))
    return done.metrics.join(n, "method").select("method", "n_queries", *[round6(F.col(f"`{c}`")).alias(c) for c in _ALL])


@register("eval_summary", _SUMMARY_SQL)
def q_eval_summary(spark, sf):
    """Methods x metrics table: BM25 (alphanumeric), BM25 (whitespace), TF-IDF (whitespace)."""
    docs, qs, qrels = fx.docs(spark, sf), fx.queries(spark, sf), fx.qrels(spark, sf)
    runs = {
        "bm25_alnum": lx.bm25_retrieve(docs, qs, 20),
        "bm25_whitespace": lx.bm25_retrieve(docs, qs, 20, tokenizer=T.tok_whitespace),
        "tfidf_whitespace": lx.tfidf_retrieve(docs, qs, 20, tokenizer=T.tok_whitespace),
    }
    allr = concat_splits(runs).withColumnRenamed("split", "method")
    methods = spark.createDataFrame([(m,) for m in runs], "method string")
    t = evaluate_run(allr, qrels, _ALL, group_cols=["method"], groups=methods)
    return t.select("method", *[round6(F.col(f"`{n}`")).alias(n) for n in _ALL])
