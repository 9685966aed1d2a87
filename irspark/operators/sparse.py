"""Sparse term features beside dense columns, for rankers.

Sparse features stay in long form (query_id, doc_id, term, value) until they are scaled; then each pair
gets two short arrays, column numbers and values, of the terms it has.  Nothing is ever laid out
over all columns.  Scaling divides by the standard deviation over all pairs, absent terms counted as
0, and removes no mean, so that what is sparse stays sparse.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import bounded_broadcast, id_str, require_columns
from .ranking import global_rank

PAIR = ["query_id", "doc_id"]
MAX_COLUMNS = 1 << 22                # weights that a driver-side model holds; more columns raise


@dataclass
class Combined:
    """Frames with the scaled dense columns, ``idx`` (array<int>) and ``val`` (array<double>) of the scaled
    sparse ones; ``columns`` (column, name, scale) numbers the dense columns from 0 and the terms after them."""
    frames: list[DataFrame]
    columns: DataFrame
    n_columns: int


def _deviation(total, squares, n):
    """Population standard deviation from sums; 1 for a constant column."""
    variance = squares / n - (total / n) * (total / n)
    return F.when(variance > 1e-12 * (squares / n), F.sqrt(variance)).otherwise(F.lit(1.0))


def combine_features(train: DataFrame, cols, sparse: DataFrame, apply_to=(), scale: bool = True) -> Combined:
    """Dense columns and sparse term features of ``train`` and of the frames ``apply_to``, scaled by ``train``.

    ``sparse`` holds (query_id, doc_id, term, value) of all the frames' pairs; a pair's repeated terms add up.
    Terms are numbered in their order.  A term that no training pair has keeps its values, and so does a constant column.
    Null dense values and values count as 0, rows without term are left out.  Pairs without sparse features get empty arrays; each
    row of a repeated pair gets the pair's features.
    """
    require_columns(sparse, {*PAIR, "term", "value"}, "sparse")
    cols, frames = list(cols), [train, *apply_to]
    long = (sparse.select(*[id_str(c).alias(c) for c in PAIR], F.col("term").cast("string").alias("term"),
                          F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))
            .where("term IS NOT NULL").groupBy(*PAIR, "term").agg(F.sum("value").alias("value")).checkpoint(eager=True))
    terms = global_rank(long.select("term").distinct(), [], ["term"], "_n").select("term", (F.col("_n") - 1 + len(cols)).cast("int").alias("column"))
    n_columns = len(cols) + terms.count()
    if n_columns > MAX_COLUMNS:
        raise ValueError(f"{n_columns} columns are more than {MAX_COLUMNS}; keep fewer terms")
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    seen = train.select(*[id_str(c).alias(c) for c in PAIR])
    n = seen.count()
    dense = train.agg(F.lit(0).alias("_"), *[F.stddev_pop(v).alias(c) for c, v in value.items()]).first()
    by = {c: (dense[c] if scale and dense[c] else 1.0) for c in cols}
    sums = (long.join(seen, PAIR).groupBy("term")
            .agg(F.sum("value").alias("total"), F.sum(F.col("value") * F.col("value")).alias("squares")))
    terms = (terms.join(sums, "term", "left")
             .select("term", "column", F.coalesce(_deviation(F.col("total"), F.col("squares"), F.lit(float(max(n, 1)))) if scale else F.lit(1.0),
                                                  F.lit(1.0)).alias("scale")).checkpoint(eager=True))
    entry = F.struct("column", (F.col("value") / F.col("scale")).alias("value"))
    arrays = (long.join(bounded_broadcast(terms), "term").groupBy(*PAIR).agg(F.sort_array(F.collect_list(entry)).alias("e"))   # a query's terms at most
              .select(*PAIR, F.col("e.column").alias("idx"), F.col("e.value").alias("val")).checkpoint(eager=True))
    none = {"idx": F.array().cast("array<int>"), "val": F.array().cast("array<double>")}
    out = []
    for df in frames:
        rest = [c for c in df.columns if c not in (*cols, *PAIR, *none)]
        shaped = df.select(*[id_str(c).alias(c) for c in PAIR], *rest, *[(v / F.lit(float(by[c]))).alias(c) for c, v in value.items()])
        out.append(shaped.join(arrays, PAIR, "left").select(*shaped.columns, *[F.coalesce(F.col(c), e).alias(c) for c, e in none.items()]))
    names = train.sparkSession.createDataFrame([(i, c, float(by[c])) for i, c in enumerate(cols)], "column int, name string, scale double")
    return Combined(out, names.unionByName(terms.select("column", F.col("term").alias("name"), "scale")), n_columns)
