"""Registered queries: sources, sinks, ranking-data formats, nesting and set operations."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..contracts import round6
from ..operators import lexical as lx
from ..operators import sets as ST
from ..operators.evaluate import evaluate_run
from ..operators.vector_table import VectorTable
from ..sources import fixtures as fx
from ..sources import io as IO
from ..sources import letor as LT
from . import sql as S
from .fusion_q import BM25_ALL
from .registry import ORACLE, register

ORACLE_EVAL = ORACLE["eval_aggregate"]


def _scratch(spark, name):
    return os.path.join(spark.conf.get("spark.checkpoint.dir"), f"{name}-{uuid.uuid4().hex}")


def _run(spark, sf, k=20):
    return lx.bm25_retrieve(fx.docs(spark, sf), fx.queries(spark, sf), k)


@register("src_corpus", "SELECT CAST(doc_id AS VARCHAR) doc_id, md5(text) text_md5, lang, source, n_chars FROM documents")
def q_src_corpus(spark, sf):
    d = IO.read_corpus(spark, os.path.join(sf, "documents.parquet"))
    return d.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@register("src_queries", f"WITH {S.QUERIES_FIX} SELECT query_id, text FROM qs")
def q_src_queries(spark, sf):
    return IO.read_queries(spark, os.path.join(sf, "benchmark.parquet"), id_col="item_id").select("query_id", "text")


@register("src_qrels", f"WITH {S.QRELS_FIX} SELECT query_id, doc_id, relevance FROM qrels")
def q_src_qrels(spark, sf):
    """Judgments written with a fractional ``score`` column instead of ``relevance`` are read
    back as integer relevance (truncation)."""
    path = _scratch(spark, "qrels")
    fx.qrels(spark, sf).select("query_id", "doc_id", (F.col("relevance") + 0.7).alias("score")) \
        .write.option("header", True).csv(path)
    return IO.read_qrels(spark, path, fmt="csv")


@register("src_run", f"WITH {BM25_ALL} SELECT * FROM run")
def q_src_run(spark, sf):
    path = _scratch(spark, "run")
    IO.write_run(_run(spark, sf), path)
    return IO.read_run(spark, path)


@register("sink_run_csv", f"WITH {BM25_ALL} SELECT query_id, doc_id, score FROM run")
def q_sink_run_csv(spark, sf):
    """The written CSV read back as plain text columns (header line per file)."""
    path = _scratch(spark, "runcsv")
    IO.write_run(_run(spark, sf), path)
    raw = spark.read.option("header", True).schema("query_id string, doc_id string, score string").csv(path)
    return raw.select("query_id", "doc_id", F.col("score").cast("double").alias("score"))


@register("sink_run_trec", f"""WITH {BM25_ALL}
SELECT query_id || ' Q0 ' || doc_id || ' ' || row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) || ' ' || printf('%.6f', score) || ' irspark' value FROM run""")
def q_sink_run_trec(spark, sf):
    path = _scratch(spark, "trec")
    IO.write_trec(_run(spark, sf), path)
    return spark.read.text(path)


@register("sink_metrics", ORACLE_EVAL)
def q_sink_metrics(spark, sf):
    path = _scratch(spark, "metrics")
    names = ["P@1", "P@10", "P@20", "AP@20", "nDCG@20"]
    m = evaluate_run(_run(spark, sf), fx.qrels(spark, sf), names)
    IO.write_metrics(m.select(*[round6(F.col(f"`{n}`")).alias(n) for n in names]), path)
    back = spark.read.json(path)
    return back.select(*[F.col(f"`{n}`").alias(n) for n in names])


_LE = "SELECT CAST(floor(l_quantity / 17) AS INTEGER) label, CAST(l_orderkey AS VARCHAR) qid, l_quantity, l_linenumber FROM lineitem"


@register("letor_parse", f"""SELECT label, qid, CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) f1, CAST(l_linenumber AS DOUBLE) f2, 2 n_features FROM ({_LE})""")
def q_letor_parse(spark, sf):
    p = LT.parse_letor(fx.letor_lines(spark, sf), "imat")
    return p.select("label", "qid", F.element_at("features", 1).alias("f1"), F.element_at("features", 2).alias("f2"),
                    F.size("features").alias("n_features"))


@register("letor_reformat", f"SELECT label || ' qid:' || qid || ' 1:' || CAST(l_quantity AS BIGINT) || ' 2:' || l_linenumber value FROM ({_LE})")
def q_letor_reformat(spark, sf):
    return LT.to_letor_lines(LT.parse_letor(fx.letor_lines(spark, sf), "imat"))


@register("letor_describe", f"""WITH x AS ({_LE}), pq AS (SELECT qid, count(*) n FROM x GROUP BY ALL),
lh AS (SELECT string_agg(label || ':' || c, ',' ORDER BY label) h FROM (SELECT label, count(*) c FROM x GROUP BY ALL))
SELECT CAST((SELECT count(*) FROM x) AS BIGINT) n_rows, CAST(count(*) AS BIGINT) n_queries, CAST(min(n) AS BIGINT) docs_min,
  round(avg(n), 6) docs_avg, CAST(max(n) AS BIGINT) docs_max, (SELECT h FROM lh) label_hist, CAST(2 AS BIGINT) n_features, 1.0::DOUBLE fill_rate FROM pq""")
def q_letor_describe(spark, sf):
    d = LT.describe_letor(LT.parse_letor(fx.letor_lines(spark, sf), "imat"))
    return d.select("n_rows", "n_queries", "docs_min", round6("docs_avg").alias("docs_avg"), "docs_max", "label_hist",
                    "n_features", round6("fill_rate").alias("fill_rate"))


@register("collect_passages", f"""WITH {BM25_ALL}, t5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) r FROM run) WHERE r <= 5)
SELECT DISTINCT t5.doc_id, md5(dd.text) text_md5 FROM t5 JOIN documents dd ON CAST(dd.doc_id AS VARCHAR) = t5.doc_id""")
def q_collect_passages(spark, sf):
    nested = ST.nest_run(_run(spark, sf, 5), fx.docs(spark, sf)).withColumnRenamed("docs", "passages")
    return IO.collect_passages(nested).select("doc_id", F.md5("text").alias("text_md5"))


@register("make_qrels", f"WITH {S.QRELS_FIX} SELECT query_id, doc_id, relevance FROM qrels")
def q_make_qrels(spark, sf):
    gold = fx.qrels(spark, sf).groupBy("query_id").agg(F.collect_list("doc_id").alias("gold_ids"))
    return IO.make_qrels(gold)


@register("split_paragraphs", """WITH p AS (SELECT CAST(doc_id AS VARCHAR) doc_id, unnest(string_split(coalesce(text, ''), chr(10))) p,
  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) pos FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) para_no FROM p WHERE trim(p) <> '')
SELECT doc_id, CAST(para_no AS INTEGER) para_no, doc_id || '_' || para_no para_id, md5(p) text_md5 FROM k""")
def q_split_paragraphs(spark, sf):
    s = IO.split_paragraphs(fx.docs(spark, sf), sep="\n")
    return s.select("doc_id", F.col("para_no").cast("int").alias("para_no"), "para_id", F.md5("text").alias("text_md5"))


_UPSERTED = """SELECT CAST(vec_id AS VARCHAR) point_id, CAST(vec_id AS VARCHAR) item_id, {label} label, '{mark}' || vec_id AS text,
  round({sign} * list_sum(list_transform(range(1, len(embedding) + 1), lambda i: i * CAST(embedding[i] AS DOUBLE))), 5) AS checksum FROM embeddings WHERE vec_id {where}"""


@register("vector_upsert", _UPSERTED.format(label="label + 100", mark="w", sign=-1, where=">= 200") + "\nUNION ALL "
          + _UPSERTED.format(label="label", mark="v", sign=1, where="< 200"))
def q_vector_upsert(spark, sf):
    """A named table of the vectors with id < 300, then a batch of ids >= 200 with changed text, payload
    and vector: the batch replaces the ids it shares.  ``checksum`` weighs components by their place."""
    v = fx.table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("item_id"),
                                                  F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("text"),
                                                  F.col("embedding").cast("array<double>").alias("embedding"), "label")
    n = F.col("item_id").cast("int")
    changed = v.filter(n >= 200).select("item_id", F.regexp_replace("text", "^v", "w").alias("text"),
                                        F.transform("embedding", lambda x: -x).alias("embedding"), (F.col("label") + 100).alias("label"))
    table = VectorTable(spark, f"upsert-{uuid.uuid4().hex}", buckets=16).upsert(v.filter(n < 300)).upsert(changed)
    weighed = F.aggregate(F.transform("embedding", lambda x, i: (i + 1) * x), F.lit(0.0), lambda a, x: a + x)
    return table.read().select("point_id", "item_id", "label", "text", F.round(weighed, 5).alias("checksum"))


@register("concat_splits", f"WITH {S.QUERIES_FIX} SELECT query_id, split FROM qs")
def q_concat_splits(spark, sf):
    q = fx.queries(spark, sf)
    parts = {s: q.filter(F.col("split") == s).drop("split") for s in ("train", "validation", "test")}
    return ST.concat_splits(parts).select("query_id", "split")


@register("filter_run_by_queries", f"WITH {BM25_ALL}, {S.QUERIES_FIX} SELECT run.* FROM run JOIN qs USING (query_id) WHERE split = 'test'")
def q_filter_run_by_queries(spark, sf):
    test = fx.queries(spark, sf).filter(F.col("split") == "test")
    return ST.filter_run(_run(spark, sf), test)


@register("distinct_pairs_sides", f"""WITH {BM25_ALL}
SELECT 'doc' side, doc_id key, min(query_id) other FROM run GROUP BY ALL
UNION ALL SELECT 'query', query_id, min(doc_id) FROM run GROUP BY ALL""")
def q_distinct_pairs_sides(spark, sf):
    c = _run(spark, sf)
    d = ST.distinct_side(c, "doc_id", ["doc_id", "query_id"]).select(F.lit("doc").alias("side"), F.col("doc_id").alias("key"), F.col("query_id").alias("other"))
    q = ST.distinct_side(c, "query_id", ["query_id", "doc_id"]).select(F.lit("query").alias("side"), F.col("query_id").alias("key"), F.col("doc_id").alias("other"))
    return d.unionByName(q)


@register("nested_results", f"""WITH {BM25_ALL}
SELECT r.query_id, r.doc_id, r.score, CAST(row_number() OVER (PARTITION BY r.query_id ORDER BY r.score DESC, r.doc_id) AS INTEGER) rank, md5(dd.text) text_md5
FROM run r JOIN documents dd ON CAST(dd.doc_id AS VARCHAR) = r.doc_id""")
def q_nested_results(spark, sf):
    n = ST.nest_run(_run(spark, sf), fx.docs(spark, sf))
    f = ST.flatten_run(n)
    return f.select("query_id", "doc_id", "score", "rank", F.md5("text").alias("text_md5"))
