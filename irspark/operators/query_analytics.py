"""Query-set analytics: statistics, difficulty bands, metric correlations, top-ranked
non-relevant documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import id_str
from .common import top_k
from .ranking import global_rank


def query_stats(queries: DataFrame, qrels: DataFrame, tokenizer) -> DataFrame:
    """#queries, mean/min/max query length in tokens, mean relevant documents per query
    (queries without judgments count 0)."""
    q = queries.select(id_str("query_id").alias("query_id"), F.size(tokenizer(F.col("text"))).alias("qlen"))
    r = qrels.filter(F.col("relevance") >= 1).groupBy("query_id").agg(F.count(F.lit(1)).alias("nrel"))
    j = q.join(r, "query_id", "left").withColumn("nrel", F.coalesce("nrel", F.lit(0)))
    return j.agg(F.count(F.lit(1)).alias("n_queries"), F.avg("qlen").alias("qlen_mean"), F.min("qlen").alias("qlen_min"),
                 F.max("qlen").alias("qlen_max"), F.avg("nrel").alias("rel_per_query"))


def query_difficulty(per_query: DataFrame, metric: str, bands: int = 4) -> DataFrame:
    """Quantile band (1 = hardest, SQL ``ntile`` semantics) and hardness rank of every query
    by a per-query metric.  Ranked with the distributed rank helper, not a one-partition
    window, so a very large query set is never ordered inside one task."""
    m = F.col(f"`{metric}`")
    base = per_query.select("query_id", m.alias("value"))
    r = global_rank(base, [], ["value", "query_id"], "hard_rank")
    n = base.agg(F.count(F.lit(1)).alias("_n"))
    r = r.crossJoin(F.broadcast(n))  # one-row count
    # ntile: the first (n mod b) bands hold q + 1 rows, the others q rows (q = n div b)
    q = F.floor(F.col("_n") / bands)
    rem = F.col("_n") % bands
    big = rem * (q + 1)
    i = F.col("hard_rank")
    band = F.when(i <= big, F.floor((i - 1) / (q + 1)) + 1).otherwise(F.floor((i - big - 1) / q) + rem + 1)
    return r.select("query_id", "value", band.cast("int").alias("band"), F.col("hard_rank").cast("int").alias("hard_rank"))


def metric_corr(df: DataFrame, pairs) -> DataFrame:
    """One row: Pearson correlation for each (a, b) column pair, named ``corr_a__b``."""
    return df.agg(*[F.corr(F.col(f"`{a}`"), F.col(f"`{b}`")).alias(f"corr_{a}__{b}") for a, b in pairs])


def top_nonrelevant(run: DataFrame, qrels: DataFrame, docs: DataFrame, n: int = 3) -> DataFrame:
    """Highest-ranked documents not judged relevant, with their text, n per query."""
    rel = qrels.filter(F.col("relevance") >= 1).select("query_id", "doc_id")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    ranked = run.withColumn("rank", F.row_number().over(w))
    nr = ranked.join(rel, ["query_id", "doc_id"], "left_anti")
    t = top_k(nr, ["query_id"], [F.col("rank").asc()], n, "nr_rank")
    return t.join(docs.select(id_str("doc_id").alias("doc_id"), "text"), "doc_id")
