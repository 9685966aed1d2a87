"""Projections and set operations over runs, queries and candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import bounded_broadcast, id_str


def concat_splits(frames: dict[str, DataFrame]) -> DataFrame:
    """Tag each frame with its split name and UNION ALL them."""
    items = [df.withColumn("split", F.lit(name)) for name, df in frames.items()]
    out = items[0]
    for it in items[1:]:
        out = out.unionByName(it, allowMissingColumns=True)
    return out


def filter_run(run: DataFrame, queries: DataFrame | None) -> DataFrame:
    """Keep run rows whose query is in ``queries``; None keeps all.  Left-semi join with the
    query-id side size-checked for broadcast."""
    if queries is None:
        return run
    ids = queries.select(id_str("query_id").alias("query_id")).distinct()
    return run.withColumn("query_id", id_str("query_id")).join(bounded_broadcast(ids), "query_id", "left_semi")


def distinct_side(cands: DataFrame, key: str, cols) -> DataFrame:
    """One row per ``key`` (deterministic: the row with the smallest other key)."""
    other = [c for c in cols if c != key]
    return cands.groupBy(key).agg(*[F.min_by(F.col(c), F.struct(*[F.col(o) for o in other])).alias(c) for c in other])


def nest_run(run: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """Flat run -> (query_id, docs: array<struct<rank, doc_id, text, score>>) in score order.
    A run holds at most k rows per query, so the per-query array is bounded by k."""
    r = run.select(id_str("query_id").alias("query_id"), id_str("doc_id").alias("doc_id"), F.col("score").cast("double"))
    if docs is not None:
        r = r.join(docs.select(id_str("doc_id").alias("doc_id"), F.col("text")), "doc_id", "left")
    else:
        r = r.withColumn("text", F.lit(None).cast("string"))
    g = r.groupBy("query_id").agg(F.collect_list(F.struct(-F.col("score"), F.col("doc_id"), F.col("text"), F.col("score"))).alias("l"))
    ordered = F.array_sort("l")
    return g.select("query_id", F.transform(ordered, lambda x, i: F.struct(
        (i + 1).alias("rank"), x["doc_id"].alias("doc_id"), x["text"].alias("text"), x["score"].alias("score"))).alias("docs"))


def flatten_run(nested: DataFrame) -> DataFrame:
    return nested.select("query_id", F.inline("docs")).select("query_id", "doc_id", "score", "rank", "text")
