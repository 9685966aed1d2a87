"""Run fusion and re-ranking: min-max per query, alpha mixing, alpha grid, top-k rescoring,
QA context assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import bounded_broadcast, id_str, literal_broadcast, require_columns, round6, text_or_empty
from .common import top_k
from .evaluate import evaluate_run


def minmax_by_query(run: DataFrame, col: str = "score", out: str = "norm") -> DataFrame:
    """(s - min) / (max - min) per query; 0.0 when max = min.  Grouped aggregate + join
    (partial min/max map-side), not a window holding a whole query in one task."""
    mm = run.groupBy("query_id").agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    j = run.join(mm, "query_id")
    v = F.when(F.col("_mx") == F.col("_mn"), F.lit(0.0)).otherwise(
        (F.col(col) - F.col("_mn")) / (F.col("_mx") - F.col("_mn")))
    return j.withColumn(out, v).drop("_mn", "_mx")


def mix_runs(bm25: DataFrame, vec: DataFrame, alpha: float) -> DataFrame:
    """alpha * minmax(bm25) + (1 - alpha) * vector score; full outer join on (query, doc),
    a missing side counts 0.0; only BM25 is normalised; unsorted, untruncated."""
    if not 0.0 <= float(alpha) <= 1.0:
        raise ValueError("alpha must be between 0 and 1")
    return mix_runs_grid(bm25, vec, None, alpha)


def mix_runs_grid(bm25: DataFrame, vec: DataFrame, alphas: DataFrame | None, alpha: float | None = None) -> DataFrame:
    b = minmax_by_query(bm25.select(id_str("query_id").alias("query_id"), id_str("doc_id").alias("doc_id"), "score"),
                        "score", "bm25_norm").drop("score")
    v = vec.select(id_str("query_id").alias("query_id"), id_str("doc_id").alias("doc_id"),
                   F.col("score").cast("double").alias("vector_score"))
    m = b.join(v, ["query_id", "doc_id"], "full_outer").select(
        "query_id", "doc_id", F.coalesce("bm25_norm", F.lit(0.0)).alias("bm25_norm"),
        F.coalesce("vector_score", F.lit(0.0)).alias("vector_score"))
    if alphas is None:
        a = F.lit(float(alpha))
        return m.select("query_id", "doc_id", (a * F.col("bm25_norm") + (1.0 - a) * F.col("vector_score")).alias("score"))
    m = m.crossJoin(literal_broadcast(alphas.select("alpha")))  # alpha grid: a driver literal, ~21 rows
    return m.select("alpha", "query_id", "doc_id",
                    (F.col("alpha") * F.col("bm25_norm") + (1.0 - F.col("alpha")) * F.col("vector_score")).alias("score"))


def alpha_grid(spark, n: int = 21) -> DataFrame:
    """0, 0.05, ..., 1 exactly as numpy.linspace(0, 1, 21) gives them (i * 0.05 in double)."""
    step = 1.0 / (n - 1)
    return spark.range(n).select((F.col("id").cast("double") * F.lit(step)).alias("alpha"))


def tune_alpha(bm25: DataFrame, vec: DataFrame, qrels: DataFrame, alphas: DataFrame | None = None,
               metric: str = "nDCG@20"):
    """Evaluate every alpha in one grouped job; best = first (smallest) alpha with the
    largest metric at 1e-6, so that float noise does not decide.
    Returns (best one-row frame (alpha, metric), full table (alpha, metric))."""
    alphas = alphas if alphas is not None else alpha_grid(bm25.sparkSession)
    mixed = mix_runs_grid(bm25, vec, alphas)
    table = evaluate_run(mixed, qrels, [metric], group_cols=["alpha"], groups=alphas)
    best = table.agg(F.min_by(F.struct(F.col("alpha"), F.col(f"`{metric}`")),
                              F.struct(-round6(F.col(f"`{metric}`")), F.col("alpha"))).alias("b")).select("b.*")
    return best, table


def rerank_run(run: DataFrame, queries: DataFrame, docs: DataFrame, scorer, top_k_: int | None = 50,
               enabled: bool = True) -> DataFrame:
    """Rescore the first ``top_k`` documents of every query with ``scorer`` (a Column over
    ``query_text`` / ``doc_text``, or a fitted Spark ML model with a ``prediction`` column);
    the rest keep their old scores.  Queries without text are dropped; docs without text are
    dropped from the rescored slice.  ``stage`` says which rows were rescored and ``rank`` is
    the order of the output (rescored slice first by new score, then the remainder)."""
    if not enabled:
        return run
    require_columns(run, {"query_id", "doc_id", "score"}, "run_df")
    require_columns(queries, {"query_id", "text"}, "queries_df")
    require_columns(docs, {"doc_id", "text"}, "docs_df")
    r = run.select(id_str("query_id").alias("query_id"), id_str("doc_id").alias("doc_id"), F.col("score").cast("double"))
    q = queries.select(id_str("query_id").alias("query_id"), F.col("text").cast("string").alias("query_text")) \
        .filter(F.col("query_text").isNotNull())
    r = r.join(bounded_broadcast(q.select("query_id")), "query_id", "left_semi")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    r = r.withColumn("_pos", F.row_number().over(w))
    cut = (F.lit(True) if top_k_ is None or top_k_ <= 0 else F.col("_pos") <= top_k_)
    head = r.filter(cut)
    rest = r.filter(~cut)
    d = docs.select(id_str("doc_id").alias("doc_id"), F.col("text").cast("string").alias("doc_text")) \
        .filter(F.col("doc_text").isNotNull())
    head = head.join(bounded_broadcast(q), "query_id").join(d, "doc_id")
    if isinstance(scorer, Column):
        head = head.withColumn("new_score", scorer.cast("double"))
    else:
        head = scorer.transform(head).withColumn("new_score", F.col("prediction").cast("double"))
    head = head.select("query_id", "doc_id", round6("new_score").alias("score"), F.lit("reranked").alias("stage"))
    wh = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    head = head.withColumn("rank", F.row_number().over(wh))
    nh = head.groupBy("query_id").agg(F.count(F.lit(1)).alias("_nh"))
    rest = (rest.join(nh, "query_id", "left")
            .select("query_id", "doc_id", round6("score").alias("score"), F.lit("kept").alias("stage"),
                    (F.coalesce("_nh", F.lit(0)) + F.col("_pos") - (top_k_ or 0)).alias("rank")))
    return head.unionByName(rest)


def rerank_candidates(cands: DataFrame, score_col: str, top_k_: int) -> DataFrame:
    """Order candidates by a score column, keep the first ``top_k`` per query."""
    return top_k(cands, ["query_id"], [F.col(score_col).desc(), F.col("doc_id").asc()], top_k_)


def build_context(run: DataFrame, docs: DataFrame, n: int, sep: str = "\n\n", mode: str = "retrieval",
                  qrels: DataFrame | None = None) -> DataFrame:
    """QA context per question: the first ``n`` passages of the run (mode 'retrieval'), the
    gold passages (mode 'oracle'), or gold first then retrieved ones not already present
    (mode 'mixed'), concatenated in order."""
    d = docs.select(id_str("doc_id").alias("doc_id"), text_or_empty("text").alias("text"))
    parts = []
    if mode in ("retrieval", "mixed"):
        r = top_k(run.select(id_str("query_id").alias("query_id"), id_str("doc_id").alias("doc_id"), "score"),
                  ["query_id"], [F.col("score").desc(), F.col("doc_id").asc()], n, "pos")
        parts.append(r.select("query_id", "doc_id", F.struct(F.lit(1).alias("src"), F.col("pos").cast("bigint").alias("n")).alias("pos")))
    if mode in ("oracle", "mixed"):
        if qrels is None:
            raise ValueError("oracle context needs qrels")
        g = qrels.filter(F.col("relevance") >= 1).select(id_str("query_id").alias("query_id"), id_str("doc_id").alias("doc_id"))
        parts.append(g.withColumn("pos", F.struct(F.lit(0).alias("src"), F.lit(0).cast("bigint").alias("n"))))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    allp = allp.groupBy("query_id", "doc_id").agg(F.min("pos").alias("pos"))
    j = allp.join(d, "doc_id")
    ctx = j.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("pos", "doc_id", "text"))).alias("p"))
    return ctx.select("query_id", F.lit(mode).alias("mode"), F.size("p").alias("n_passages"),
                      F.array_join(F.transform("p", lambda x: x["text"]), sep).alias("context"))
