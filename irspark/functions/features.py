"""Learning-to-rank pair features f1..f11 as Column expressions over two token arrays.

All are computed inside the row (no join, no shuffle).  Lambdas capture only the two
input arrays; pass plain columns (the table-level operator stages and checkpoints token
arrays first) so nothing is recomputed per element.  Fractions that would divide by zero give 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bigrams


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def f_query_length(q, d) -> Column:
    return F.size(_c(q)).cast("double")


def f_doc_length(q, d) -> Column:
    return F.size(_c(d)).cast("double")


def f_min_term_distance(q, d) -> Column:
    """Smallest position gap between two DIFFERENT query terms in the document; the document
    length when fewer than two distinct query terms occur.  Linear after one sort: among
    matched positions in order, the closest differing pair is always adjacent."""
    qd, dd = _c(q), _c(d)
    n = F.size(dd)
    matched = F.filter(F.transform(dd, lambda t, i: F.struct(i.alias("p"), t.alias("t"))),
                       lambda s: F.array_contains(qd, s["t"]))
    nxt = F.slice(matched, 2, F.greatest(F.size(matched) - 1, F.lit(0)))
    gaps = F.zip_with(matched, nxt, lambda a, b: F.when(b.isNotNull() & (a["t"] != b["t"]), b["p"] - a["p"]))
    return F.coalesce(F.array_min(gaps), n).cast("double")


def f_n_intersecting(q, d) -> Column:
    return F.size(F.array_intersect(_c(q), _c(d))).cast("double")


def f_frac_intersecting(q, d) -> Column:
    return _div(F.size(F.array_intersect(_c(q), _c(d))), F.size(_c(q)))


def f_n_hits(q, d) -> Column:
    dd = _c(d)
    return F.size(F.filter(_c(q), lambda x: F.array_contains(dd, x))).cast("double")


def f_frac_hits(q, d) -> Column:
    return _div(f_n_hits(q, d), F.size(_c(d)))


def f_bigram_overlap(q, d) -> Column:
    return F.size(F.array_intersect(bigrams(_c(q)), bigrams(_c(d)))).cast("double")


def f_bigram_overlap_frac(q, d) -> Column:
    qb, db = bigrams(_c(q)), bigrams(_c(d))
    return F.when(F.size(qb) == 0, F.lit(0.0)).otherwise(
        _div(F.size(F.array_intersect(qb, db)), F.size(F.array_distinct(db))))


def f_bigram_hits(q, d) -> Column:
    return bigram_hits(bigrams(_c(q)), bigrams(_c(d)))


def bigram_hits(qb, db) -> Column:
    """Query bigrams (repeats counted) present among the document bigrams; pass attribute
    columns so the lambda does not recompute the bigram arrays."""
    dbc = _c(db)
    return F.size(F.filter(_c(qb), lambda x: F.array_contains(dbc, x))).cast("double")


def f_bigram_hits_frac(q, d) -> Column:
    db = bigrams(_c(d))
    return F.when(F.size(db) == 0, F.lit(0.0)).otherwise(_div(bigram_hits(bigrams(_c(q)), db), F.size(db)))


# Default feature order f1..f11.
DEFAULT_FEATURES = [
    f_query_length,
    f_doc_length,
    f_min_term_distance,
    f_n_intersecting,
    f_frac_intersecting,
    f_n_hits,
    f_frac_hits,
    f_bigram_overlap,
    f_bigram_hits,
    f_bigram_overlap_frac,
    f_bigram_hits_frac,
]
