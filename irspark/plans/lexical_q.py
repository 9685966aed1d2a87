"""Registered queries: index statistics and lexical retrieval (BM25, TF-IDF, ...)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import round6
from ..operators import lexical as lx
from ..operators.index import build_index, term_stats
from ..sources import fixtures as fx
from . import sql as S
from .registry import register

K = 20


def bm25_run(spark, sf_dir, k: int = K):
    return lx.bm25_retrieve(fx.docs(spark, sf_dir), fx.queries(spark, sf_dir), k)


@register("bm25_topk", f"""WITH {S.docs_tokens()}, {S.query_tokens()}, {S.INDEX.strip()}, {S.QTERMS},
{S.bm25_scores().strip()}, {S.topk('s', K)}
SELECT * FROM run""")
def q_bm25_topk(spark, sf_dir):
    return bm25_run(spark, sf_dir)


@register("term_stats", f"""WITH {S.docs_tokens()}, {S.INDEX.strip()},
cf AS (SELECT term, count(*) df, sum(tf) cf FROM p GROUP BY ALL)
SELECT term, df, CAST(cf AS BIGINT) cf, CAST(st.n AS BIGINT) n_docs, round(st.avgdl, 6) avgdl FROM cf, st""")
def q_term_stats(spark, sf_dir):
    ts = term_stats(build_index(fx.docs(spark, sf_dir)))
    return ts.select("term", "df", "cf", "n_docs", round6("avgdl").alias("avgdl"))
