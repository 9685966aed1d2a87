"""Registered queries: query-set analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import round6
from ..functions import text as T
from ..operators import lexical as lx
from ..operators import query_analytics as QA
from ..operators.evaluate import evaluate_run
from ..sources import fixtures as fx
from . import sql as S
from .eval_q import _BASE
from .registry import register


@register("query_stats", f"""WITH {S.query_tokens()}, {S.QRELS_FIX},
r AS (SELECT query_id, count(*) nrel FROM qrels GROUP BY ALL),
j AS (SELECT qt.query_id, len(toks) qlen, coalesce(nrel, 0) nrel FROM qt LEFT JOIN r USING (query_id))
SELECT CAST(count(*) AS BIGINT) n_queries, round(avg(qlen), 6) qlen_mean, CAST(min(qlen) AS INTEGER) qlen_min,
  CAST(max(qlen) AS INTEGER) qlen_max, round(avg(nrel), 6) rel_per_query FROM j""")
def q_query_stats(spark, sf):
    s = QA.query_stats(fx.queries(spark, sf), fx.qrels(spark, sf), T.tok_alnum)
    return s.select("n_queries", round6("qlen_mean").alias("qlen_mean"), "qlen_min", "qlen_max",
                    round6("rel_per_query").alias("rel_per_query"))


def _per_query(spark, sf):
    run = lx.bm25_retrieve(fx.docs(spark, sf), fx.queries(spark, sf), 20)
    _, pq = evaluate_run(run, fx.qrels(spark, sf), ["P@10", "nDCG@20"], per_query=True)
    return pq


@register("query_difficulty", _BASE + """
SELECT query_id, round("nDCG@20", 6) value, CAST(ntile(4) OVER (ORDER BY round("nDCG@20", 6), query_id) AS INTEGER) band,
  CAST(row_number() OVER (ORDER BY round("nDCG@20", 6), query_id) AS INTEGER) hard_rank FROM pq""")
def q_query_difficulty(spark, sf):
    pq = _per_query(spark, sf).withColumn("nDCG@20", round6(F.col("`nDCG@20`")))
    return QA.query_difficulty(pq, "nDCG@20").select("query_id", "value", "band", "hard_rank")


@register("metric_correlation", _BASE + """,
r AS (SELECT query_id, count(*) nrel FROM qrels GROUP BY ALL),
qmi AS (SELECT q.query_id, avg(idf.idf) mean_idf, sum(q.qtf) qlen FROM q JOIN idf USING (term) GROUP BY ALL),
x AS (SELECT pq.*, coalesce(r.nrel, 0) nrel, qmi.mean_idf, qmi.qlen FROM pq LEFT JOIN r USING (query_id) LEFT JOIN qmi USING (query_id))
SELECT round(corr(qlen, "nDCG@20"), 6) "corr_qlen__nDCG@20", round(corr(nrel, "nDCG@20"), 6) "corr_nrel__nDCG@20",
  round(corr(mean_idf, "nDCG@20"), 6) "corr_mean_idf__nDCG@20", round(corr("P@10", "nDCG@20"), 6) "corr_P@10__nDCG@20" FROM x""")
def q_metric_correlation(spark, sf):
    """Correlation of query length, number of relevant documents and mean idf with nDCG@20,
    and of P@10 with nDCG@20, over the queries."""
    docs, qs, qrels = fx.docs(spark, sf), fx.queries(spark, sf), fx.qrels(spark, sf)
    idx = lx.build_index(docs)
    run = lx.bm25_retrieve(idx, qs, 20)
    _, pq = evaluate_run(run, qrels, ["P@1", "P@10", "P@20", "AP@20", "nDCG@20"], per_query=True)
    qt = lx.query_terms(qs)
    idf = lx.bm25_idf(idx, 0.25, terms=qt.select("term").distinct())
    mi = qt.join(idf, "term").groupBy("query_id").agg(F.avg("idf").alias("mean_idf"), F.sum("qtf").alias("qlen"))
    nrel = qrels.groupBy("query_id").agg(F.count(F.lit(1)).alias("nrel"))
    x = pq.join(nrel, "query_id", "left").withColumn("nrel", F.coalesce("nrel", F.lit(0))).join(mi, "query_id", "left")
    c = QA.metric_corr(x, [("qlen", "nDCG@20"), ("nrel", "nDCG@20"), ("mean_idf", "nDCG@20"), ("P@10", "nDCG@20")])
    return c.select(*[round6(F.col(f"`{n}`")).alias(n) for n in c.columns])


@register("top_nonrelevant", f"""WITH {S.docs_tokens()}, {S.query_tokens()}, {S.INDEX.strip()}, {S.QTERMS},
{S.bm25_scores().strip()}, {S.topk('s', 20)}, {S.QRELS_FIX},
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) rank FROM run),
nr AS (SELECT * FROM rk WHERE NOT EXISTS (SELECT 1 FROM qrels q WHERE q.query_id = rk.query_id AND q.doc_id = rk.doc_id)),
t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) nr_rank FROM nr)
SELECT t.query_id, t.doc_id, t.score, CAST(t.rank AS INTEGER) rank, CAST(nr_rank AS INTEGER) nr_rank, md5(dd.text) text_md5
FROM t JOIN documents dd ON CAST(dd.doc_id AS VARCHAR) = t.doc_id WHERE nr_rank <= 3""")
def q_top_nonrelevant(spark, sf):
    docs, qs = fx.docs(spark, sf), fx.queries(spark, sf)
    run = lx.bm25_retrieve(docs, qs, 20)
    t = QA.top_nonrelevant(run, fx.qrels(spark, sf), docs, 3)
    return t.select("query_id", "doc_id", "score", F.col("rank").cast("int").alias("rank"),
                    F.col("nr_rank").cast("int").alias("nr_rank"), F.md5("text").alias("text_md5"))
