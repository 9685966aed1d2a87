"""TREC-style evaluation (trec_eval conventions) as one grouped job.

Conventions: relevant = relevance >= 1; run ranks by score DESC then doc_id DESC (trec_eval
tie order); P@k divides by k even for short runs; AP@k divides by ALL relevant documents
of the query; nDCG gain = relevance (<= 0 counts 0), discount log2(rank+1), ideal from the
qrels; the mean is over the queries of the qrels, a query absent from the run scoring 0;
run queries without qrels are ignored.

Any extra ``group_cols`` (split, run name, alpha, k1/b ...) are evaluated side by side in
the same job instead of in a driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import DEFAULT_METRICS, Measure, bounded_broadcast, id_str, parse_measure, require_columns
from .common import top_k

IDEAL_BLOCK = 4096       # ranks of the ideal order that one row sums up


def normalize_qrels(qrels: DataFrame, keep=()) -> DataFrame:
    """(query_id, doc_id, relevance INT); ``score`` is accepted when ``relevance`` is absent.
    ``int()`` semantics: truncation toward zero."""
    rel = "relevance" if "relevance" in qrels.columns else "score"
    require_columns(qrels, {"query_id", "doc_id", rel}, "qrels_df")
    return qrels.select(*keep, id_str("query_id").alias("query_id"), id_str("doc_id").alias("doc_id"),
                        F.col(rel).cast("double").cast("int").alias("relevance"))


def _measures(metrics) -> list[Measure]:
    ms = [parse_measure(m) for m in (metrics or DEFAULT_METRICS)]
    out: list[Measure] = []
    for m in ms:
        if m not in out:
            out.append(m)
    return out


def per_query_metrics(run: DataFrame, qrels: DataFrame, metrics=None, group_cols=(),
                      missing_as_zero: bool = True, groups: DataFrame | None = None) -> DataFrame:
    """Wide table: group_cols..., query_id, one DOUBLE column per measure (named like P@10).

    ``groups`` is the (small, literal) table of group keys when the caller knows it, e.g. an
    alpha or k1/b grid; it is broadcast against the judged queries.  Without it the groups
    are the distinct keys of the run."""
    measures = _measures(metrics)
    g = list(group_cols)
    require_columns(run, {"query_id", "doc_id", "score", *g}, "run_df")
    qr_keep = [c for c in g if c in qrels.columns]
    q = normalize_qrels(qrels, qr_keep)
    r = run.select(*g, id_str("query_id").alias("query_id"), id_str("doc_id").alias("doc_id"),
                   F.col("score").cast("double").alias("score")).checkpoint(eager=True)

    # The judgments are read once and counted by query and relevance; by document too only where the run has it.
    keys = [*qr_keep, "query_id"]
    asked = bounded_broadcast(r.select(*keys, "doc_id").distinct().withColumn("_asked", F.lit(True)), checkpoint=True)
    seen = (q.join(asked, [*keys, "doc_id"], "left")
            .groupBy(*keys, "relevance", F.when(F.col("_asked"), F.col("doc_id")).alias("_doc"))
            .agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True))
    pairs = (seen.where("_doc IS NOT NULL")                      # a judgment given twice counts twice
             .select(*keys, F.col("_doc").alias("doc_id"), "relevance", F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int"))).alias("_i")).drop("_i"))
    judged = r.join(bounded_broadcast(seen.select(*keys).distinct()), keys, "left_semi")
    j = judged.join(bounded_broadcast(pairs), [*keys, "doc_id"], "left")
    rel = F.coalesce(F.col("relevance"), F.lit(0))
    by_score = [F.col("score").desc(), F.col("doc_id").desc()]
    cutoffs = [m.cutoff for m in measures]
    if cutoffs and None not in cutoffs:     # rows beyond every cutoff never leave their task
        ranked = top_k(j, [*g, "query_id"], by_score, max(cutoffs), "rank")
    else:
        ranked = j.withColumn("rank", F.row_number().over(Window.partitionBy(*g, "query_id").orderBy(*by_score)))
    upto = Window.partitionBy(*g, "query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (ranked.withColumn("rel", rel)
              .withColumn("isrel", (F.col("rel") >= 1).cast("int"))
              .withColumn("cumrel", F.sum("isrel").over(upto)))
    gain = F.greatest(F.col("rel"), F.lit(0)).cast("double")
    disc = F.log2(F.col("rank") + 1.0)
    aggs = []
    for m in measures:
        cut = (F.col("rank") <= m.cutoff) if m.cutoff is not None else F.lit(True)
        if m.kind == "P":
            if m.cutoff is None:
                raise ValueError("P needs a cutoff")
            aggs.append((F.sum(F.when(cut, F.col("isrel")).otherwise(0)) / float(m.cutoff)).alias(m.name))
        elif m.kind == "AP":
            aggs.append(F.sum(F.when(cut & (F.col("isrel") == 1), F.col("cumrel") / F.col("rank"))
                              .otherwise(0.0)).alias("_ap_" + m.name))
        elif m.kind == "nDCG":
            aggs.append(F.sum(F.when(cut, gain / disc).otherwise(0.0)).alias("_dcg_" + m.name))
        elif m.kind == "RR":
            aggs.append(F.max(F.when(cut & (F.col("isrel") == 1), 1.0 / F.col("rank")).otherwise(0.0)).alias(m.name))
        elif m.kind == "R":
            aggs.append(F.sum(F.when(cut, F.col("isrel")).otherwise(0)).alias("_rec_" + m.name))
    runq = ranked.groupBy(*g, "query_id").agg(*aggs)

    # ideal side: per query number relevant and ideal DCG at each cutoff, from the number of judgments by relevance
    counts = seen.groupBy(*keys, "relevance").agg(F.sum("_n").alias("_n"))
    above = Window.partitionBy(*keys).orderBy(F.col("relevance").desc()).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(above), F.lit(0).cast("bigint")))
    cuts = [m.cutoff for m in measures if m.kind == "nDCG"]
    last = F.col("_before") + F.col("_n")
    last = F.least(last, F.lit(max(cuts, default=0)).cast("bigint")) if None not in cuts else last
    # ranks of one relevance, in blocks, as far as a measure looks
    counts = (counts.withColumn("_last", F.when(F.col("relevance") > 0, last).otherwise(F.col("_before")))
              .withColumn("_from", F.explode(F.sequence(F.col("_before"), F.greatest(F.col("_last") - 1, F.col("_before")), F.lit(IDEAL_BLOCK).cast("bigint")))))
    iaggs = [F.sum(F.when(F.col("_from") == F.col("_before"), (F.col("relevance") >= 1).cast("int") * F.col("_n"))).alias("_nrel")]
    for m in measures:
        if m.kind == "nDCG":
            upto = F.least(F.col("_last"), F.col("_from") + IDEAL_BLOCK)
            upto = upto if m.cutoff is None else F.least(upto, F.lit(m.cutoff).cast("bigint"))
            dcg = F.aggregate(F.sequence(F.col("_from") + 1, upto), F.lit(0.0),
                              lambda s, i: s + F.col("relevance").cast("double") / F.log2(i + 1.0))
            iaggs.append(F.sum(F.when(upto > F.col("_from"), dcg).otherwise(0.0)).alias("_idcg_" + m.name))
    ideal = counts.groupBy(*keys).agg(*iaggs)

    # every (group, judged query): groups come from the run, queries from the qrels
    if missing_as_zero:
        if len(qr_keep) < len(g):
            if groups is not None:
                # literal grid x judged queries: the grid side is broadcast
                base = ideal.join(F.broadcast(groups.select(*g)), qr_keep) if qr_keep else ideal.crossJoin(F.broadcast(groups.select(*g)))
            else:
                # every run group x judged query is a row of the result; the groups are few
                run_groups = bounded_broadcast(run.select(*g).distinct())
                base = ideal.join(run_groups, qr_keep) if qr_keep else ideal.crossJoin(run_groups)
        else:
            base = ideal
        out = base.join(runq, [*g, "query_id"], "left")
    else:
        out = runq.join(ideal, [*qr_keep, "query_id"])
    cols = []
    for m in measures:
        if m.kind == "AP":
            v = F.coalesce(F.try_divide(F.col("_ap_" + m.name), F.col("_nrel").cast("double")), F.lit(0.0))
        elif m.kind == "nDCG":
            v = F.coalesce(F.try_divide(F.col("_dcg_" + m.name), F.col("_idcg_" + m.name)), F.lit(0.0))
        elif m.kind == "R":
            v = F.coalesce(F.try_divide(F.col("_rec_" + m.name).cast("double"), F.col("_nrel").cast("double")), F.lit(0.0))
        else:
            v = F.coalesce(F.col(m.name).cast("double"), F.lit(0.0))
        cols.append(v.alias(m.name))
    return out.select(*g, "query_id", *cols)


def evaluate_run(run: DataFrame, qrels: DataFrame, metrics=None, per_query: bool = False, group_cols=(),
                 missing_as_zero: bool = True, groups: DataFrame | None = None):
    """-> aggregate frame (group_cols..., one column per measure).  With ``per_query`` the
    per-query wide table is returned as a second value."""
    measures = _measures(metrics)
    pq = per_query_metrics(run, qrels, measures, group_cols, missing_as_zero, groups)
    agg = pq.groupBy(*group_cols).agg(*[F.avg(F.col(f"`{m.name}`")).alias(m.name) for m in measures])
    return (agg, pq) if per_query else agg


def ndcg_at_k(df: DataFrame, score_col: str, k: int = 20, query_col: str = "query_id", doc_col: str = "doc_id",
              relevance_col: str = "relevance") -> DataFrame:
    """nDCG@k of a scored, labelled candidate frame (labels double as qrels)."""
    run = df.select(F.col(query_col).alias("query_id"), F.col(doc_col).alias("doc_id"), F.col(score_col).alias("score"))
    qrels = df.select(F.col(query_col).alias("query_id"), F.col(doc_col).alias("doc_id"),
                      F.col(relevance_col).alias("relevance"))
    return evaluate_run(run, qrels, [f"nDCG@{k}"])
