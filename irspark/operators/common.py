"""Small shared building blocks: per-group top-k, scalar attach, run shaping."""

from __future__ import annotations

import gc
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contracts import round6


def attach_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a ONE-ROW aggregate (corpus N, avgdl, mean idf ...) to every row.

    The right side is a global aggregate, so it has exactly one row by construction; it is
    broadcast and the join is a map-side projection, never a product of two tables.
    """
    return df.crossJoin(F.broadcast(scalars))


def top_k(df: DataFrame, group_cols, order_cols, k: int, rank_col: str | None = "rank") -> DataFrame:
    """Keep the first ``k`` rows per group.  ``row_number() <= k`` lets Spark insert a
    WindowGroupLimit before the shuffle (partial top-k per map task), so a hot group sends
    at most k rows per task downstream, never its whole row set."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    name = rank_col or "_rank"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def ranked_run(scores: DataFrame, k: int, tie: str = "asc", keep_rank: bool = False) -> DataFrame:
    """(query_id, doc_id, score) -> top-k per query; score reported at 1e-6, rank follows
    the reported score, ties by doc_id (ascending for retrieval output)."""
    s = scores.withColumn("score", round6("score"))
    tie_col = F.col("doc_id").asc() if tie == "asc" else F.col("doc_id").desc()
    out = top_k(s, ["query_id"], [F.col("score").desc(), tie_col], k)
    cols = ["query_id", "doc_id", "score"] + (["rank"] if keep_rank else [])
    return out.select(*cols)


@contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int):
    """While it lasts, Arrow batches sent to Python hold at most ``most_bytes``: for jobs run inside, whose
    rows are large.  The session's own setting comes back at the end."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most_bytes))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def first_of_ties(c, r, ids, at_least, kk):
    """Columns above the k-th rounded score, and the first ``kk`` by id at it and at the step below."""
    keep = [c[r[c] > at_least]]
    for step in (at_least, at_least - 1):
        tied = c[r[c] == step]
        keep.append(tied[np.argsort(ids[tied], kind="stable")[:kk]])
    return np.concatenate(keep)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of frames that are no longer referred to: it does so when the driver
    collects its garbage, which in a job of large shuffles and little driver work may be too late for the disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
