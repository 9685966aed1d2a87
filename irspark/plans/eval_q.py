"""Registered queries: TREC-style evaluation of the BM25 run against containment qrels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import round6
from ..operators import lexical as lx
from ..operators.evaluate import evaluate_run
from ..sources import fixtures as fx
from . import sql as S
from .lexical_q import K, bm25_run
from .registry import register

_BASE = f"""WITH {S.docs_tokens()}, {S.query_tokens()}, {S.INDEX.strip()}, {S.QTERMS},
{S.bm25_scores().strip()}, {S.topk('s', K)}, {S.QRELS_FIX}, {S.eval_metrics().strip()},
pq AS (SELECT iq.query_id, coalesce(rq."P@1", 0) "P@1", coalesce(rq."P@10", 0) "P@10", coalesce(rq."P@20", 0) "P@20",
         coalesce(ap_num::DOUBLE / nullif(nrel, 0), 0) "AP@20", coalesce(dcg / nullif(idcg, 0), 0) "nDCG@20"
       FROM iq LEFT JOIN rq USING (query_id))"""


def _metric_cols(names):
    return ", ".join(f'round(avg("{n}"), 6) "{n}"' for n in names)


def _eval(spark, sf_dir, metrics, per_query=False):
    run = bm25_run(spark, sf_dir)
    qrels = fx.qrels(spark, sf_dir)
    return evaluate_run(run, qrels, metrics, per_query=per_query)


def _rounded(df, names):
    return df.select(*[round6(F.col(f"`{n}`")).alias(n) for n in names])


@register("eval_precision", f"{_BASE}\nSELECT {_metric_cols(['P@1', 'P@10', 'P@20'])} FROM pq")
def q_eval_precision(spark, sf_dir):
    names = ["P@1", "P@10", "P@20"]
    return _rounded(_eval(spark, sf_dir, names), names)


DEEP = 1000
_DEEP_SQL = f"""WITH {S.docs_tokens()}, {S.query_tokens()}, {S.INDEX.strip()}, {S.QTERMS},
{S.bm25_scores().strip()}, {S.topk('s', DEEP)}, {S.QRELS_FIX}, {S.eval_metrics(k_ap=20).strip()},
whole AS (SELECT query_id, sum(CASE WHEN isrel = 1 THEN cumrel::DOUBLE / rk ELSE 0 END) num FROM rr GROUP BY ALL),
pq AS (SELECT iq.query_id, coalesce(ap_num::DOUBLE / nullif(nrel, 0), 0) "AP@20", coalesce(num / nullif(nrel, 0), 0) "AP"
       FROM iq LEFT JOIN rq USING (query_id) LEFT JOIN whole USING (query_id))"""


@register("eval_map", f"{_DEEP_SQL}\nSELECT {_metric_cols(['AP@20', 'AP'])} FROM pq")
def q_eval_map(spark, sf_dir):
    """AP at 20 and uncut, of a run of up to 1,000 documents a query."""
    run = lx.bm25_retrieve(fx.docs(spark, sf_dir), fx.queries(spark, sf_dir), DEEP, fill=False)
    names = ["AP@20", "AP"]
    return _rounded(evaluate_run(run, fx.qrels(spark, sf_dir), names), names)


@register("eval_ndcg", f"{_BASE}\nSELECT {_metric_cols(['nDCG@20'])} FROM pq")
def q_eval_ndcg(spark, sf_dir):
    return _rounded(_eval(spark, sf_dir, ["nDCG@20"]), ["nDCG@20"])


_ALL = ["P@1", "P@10", "P@20", "AP@20", "nDCG@20"]


@register("eval_aggregate", f"{_BASE}\nSELECT {_metric_cols(_ALL)} FROM pq")
def q_eval_aggregate(spark, sf_dir):
    return _rounded(_eval(spark, sf_dir, _ALL), _ALL)


@register("eval_per_query", f"{_BASE}\nSELECT query_id, " + ", ".join(f'round("{n}", 6) "{n}"' for n in _ALL) + " FROM pq")
def q_eval_per_query(spark, sf_dir):
    _, pq = _eval(spark, sf_dir, _ALL, per_query=True)
    return pq.select("query_id", *[round6(F.col(f"`{n}`")).alias(n) for n in _ALL])
