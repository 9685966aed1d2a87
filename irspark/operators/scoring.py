"""Top-k of sums over terms, without a row per (query, document, term).

The forward index holds all terms of a document in one row.  A task multiplies slices of it with the weights of the
queries: terms that are frequent in the slice as a dense product, the others along their postings.  Only the best
documents of each query leave the task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..contracts import fits_broadcast
from .common import arrow_batches, first_of_ties

MOST_QUERIES = 4096     # beyond it the rows of a slice would be few
MOST_ENTRIES = 1 << 20  # (query, term) weights that go to the workers
CELLS = 1 << 19         # scores that a task holds at once
PRODUCTS = 1 << 19      # products of postings that it expands at once
DENSE_SHARE = 1 / 32    # terms of so many of a slice's documents are multiplied as a dense matrix
BATCH_BYTES = 8 << 20
RUN_SCHEMA = "query_id string, doc_id string, score double"


def fits_blocks(index, side: DataFrame) -> bool:
    """Whether the queries' side (query_id, term, ...) may go to the workers, and every document is one row."""
    if index.rows is None or not fits_broadcast(side, MOST_ENTRIES):
        return False
    if side.select("query_id").distinct().limit(MOST_QUERIES + 1).count() > MOST_QUERIES:
        return False
    return index.doc_len.groupBy("doc_id").count().where("count > 1").isEmpty()


def _slice(batch, vocabulary, weight):
    """Row, term number, weight of the postings of a batch whose term is in the vocabulary."""
    tc = batch.column(2)
    flat = tc.flatten()
    t = pc.fill_null(pc.index_in(flat.field(0), value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(tc)), pc.fill_null(tc.value_lengths(), 0).to_numpy(zero_copy_only=False))
    there = np.flatnonzero(t >= 0)
    row, t = row[there], t[there]
    tf = flat.field(1).to_numpy(zero_copy_only=False)[there].astype(float)
    return row, t, weight(tf, batch.column(1).to_numpy(zero_copy_only=False)[row].astype(float))


def _sums(row, t, w, n, start, count, q, value, n_q):
    """n x n_q sums of the products of the postings (row, t, w) with the entries (q, value) of their terms."""
    many = np.bincount(t, minlength=len(count))
    dense = np.flatnonzero(many > DENSE_SHARE * n)
    column = np.full(len(count), -1)
    column[dense] = np.arange(len(dense))
    entry = np.concatenate([np.arange(start[d], start[d] + count[d]) for d in dense]) if len(dense) else np.zeros(0, np.int64)
    side = np.bincount(np.repeat(np.arange(len(dense)), count[dense]) * n_q + q[entry], value[entry], len(dense) * n_q).reshape(len(dense), n_q)
    c = column[t]
    some = c >= 0
    out = np.bincount(row[some] * len(dense) + c[some], w[some], n * len(dense)).reshape(n, len(dense)) @ side
    row, t, w = row[~some], t[~some], w[~some]
    ends = np.cumsum(count[t])
    at = 0
    while at < len(t):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PRODUCTS, "right")))
        m = count[t[at:to]]
        done = np.cumsum(m)
        e = np.arange(done[-1]) + np.repeat(start[t[at:to]] - done + m, m)
        out += np.bincount(np.repeat(row[at:to] * n_q, m) + q[e], np.repeat(w[at:to], m) * value[e], n * n_q).reshape(n, n_q)
        at = to
    return out


def _best(shared, weight, k: int):
    def run(batches):
        terms, names, start, count, q, value = shared.value
        vocabulary, n_q = pa.array(terms, pa.string()), len(names)
        positive = bool((value > 0).all())               # then a sum above 0 is a match
        bound, names = np.full(n_q, -np.inf), np.asarray(names, dtype=object)
        step = max(1, CELLS // n_q)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                n, ids = some.num_rows, np.asarray(some.column(0).to_pylist(), dtype=object)
                row, t, w = _slice(some, vocabulary, weight)
                s = _sums(row, t, w, n, start, count, q, value, n_q)
                match = s > 0 if positive else _sums(row, t, np.ones(len(t)), n, start, count, q, np.ones(len(q)), n_q) > 0.5
                if some.num_columns > 3:
                    s = s / some.column(3).to_numpy(zero_copy_only=False)[:, None]
                r = np.where(match, np.floor(s * 1e6 + 0.5), -np.inf).T
                kk = min(k, n)
                kth = -np.partition(-r, kk - 1, axis=1)[:, kk - 1] if kk == k else np.full(n_q, -np.inf)
                bound = np.maximum(bound, kth)           # k documents reach it
                picked = []
                for i in range(n_q):
                    c = np.flatnonzero((r[i] >= bound[i] - 1) & match[:, i])        # one step of slack for rounding
                    picked.append(c if len(c) <= k else first_of_ties(c, r[i], ids, bound[i], k))
                who = np.repeat(np.arange(n_q), [len(c) for c in picked])
                docs = np.concatenate(picked)
                if len(docs):
                    yield pa.RecordBatch.from_arrays([pa.array(names[who], pa.string()), pa.array(ids[docs], pa.string()), pa.array(s[docs, who])],
                                                     ["query_id", "doc_id", "score"])
    return run


def best_sums(rows: DataFrame, side: DataFrame, value: str, weight, k: int) -> DataFrame:
    """(query_id, doc_id, score) with the ``k`` best documents of each query, and more: score is the sum over the common
    terms of ``value`` of the query's side (query_id, term, value) and ``weight(tf, dl)`` of the document,
    over the fourth column of ``rows`` (doc_id, dl, tc, divisor) if there is one.  ``side`` must be written."""
    spark = rows.sparkSession
    table = side.select("query_id", "term", value).toArrow()
    terms = sorted(set(table["term"].to_pylist()))
    number = {x: i for i, x in enumerate(terms)}
    names = list(dict.fromkeys(table["query_id"].to_pylist()))
    place = {x: i for i, x in enumerate(names)}
    if not names:
        return spark.createDataFrame([], RUN_SCHEMA)
    t = np.array([number[x] for x in table["term"].to_pylist()], np.int64)
    q = np.array([place[x] for x in table["query_id"].to_pylist()], np.int64)
    order = np.lexsort((q, t))
    count = np.bincount(t, minlength=len(terms))
    shared = spark.sparkContext.broadcast((terms, names, np.cumsum(count) - count, count, q[order],
                                           table[value].to_numpy().astype(float)[order]))
    with arrow_batches(spark, BATCH_BYTES):
        return rows.mapInArrow(_best(shared, weight, k), RUN_SCHEMA).checkpoint(eager=True)
