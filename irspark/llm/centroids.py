"""Centroid clustering with ns-bounds.

Every vector keeps a distance to its own centroid and one to each other centroid, each with the round
in which it was evaluated.  The centroids of all rounds are kept, so a bound is loosened by the norm of
the centroid's total displacement since that round, not by the sum of its drifts round by round.  A
vector whose upper bound stays below all its lower bounds needs no evaluation; the others are rescanned
exactly, and only against the centroids whose bound failed.  Vectors and centroids are integers, so
distances, ties and means are exact; bounds only decide what is evaluated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut, map_batches

LARGEST = 1 << 27                    # components beyond it could overflow a squared distance
SLACK = 1e-9                         # margin of the bounds over the rounding of floats
_STATE = "vec_id bigint, q binary, cluster int, own double, own_at int, low binary, low_at binary, evaluated int"


def _matrix(column, dtype: str, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(rows, -1)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _quantise(components: int, scale: int):
    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), components), False))
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)   # null: nan
            keep = np.isfinite(x).all(axis=1)
            x = np.floor(scale * x[keep])
            if len(x) and np.abs(x).max() > LARGEST:
                raise ValueError(f"components beyond {LARGEST} after scaling have no exact distance in a long")
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), _binary(x.astype("<i4"))], ["vec_id", "q"])
    return run


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer centroids, as a matrix of longs."""
    top = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) + 1
    if int(top) ** 2 * x.shape[1] < 1 << 50:            # every sum is an integer that a double holds
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


class History:
    """The centroids of all rounds so far, with each one's displacement since every round."""

    def __init__(self, start: np.ndarray):
        self.rounds = [start.astype(np.int64)]

    def add(self, centroids: np.ndarray) -> None:
        self.rounds.append(centroids)

    def displaced(self) -> np.ndarray:
        """[round, centroid]: norm of what lies between that round's centroid and the present one, rounded up."""
        now = self.rounds[-1].astype(np.float64)
        return np.stack([np.sqrt(((now - c) ** 2).sum(1)) for c in self.rounds]) * (1 + SLACK)


def _first(x: np.ndarray, centroids: np.ndarray):
    d = squared_distances(x, centroids)
    cluster = d.argmin(1)                               # of equal distances the smaller number
    low = np.sqrt(d.astype(np.float64))
    return cluster, low[np.arange(len(x)), cluster], np.zeros(len(x), np.int64), low, np.zeros(d.shape, np.int64), \
        np.full(len(x), d.shape[1])


def reassign(x: np.ndarray, cluster: np.ndarray, own: np.ndarray, own_at: np.ndarray, low: np.ndarray,
             low_at: np.ndarray, evaluated: np.ndarray, history: History):
    """The state of the vectors after the round that starts from the last centroids of ``history``."""
    now, centroids, drift = len(history.rounds) - 1, history.rounds[-1], history.displaced()
    cluster, own, own_at, low, low_at, evaluated = (a.copy() for a in (cluster, own, own_at, low, low_at, evaluated))
    k, every = len(centroids), np.arange(len(x))
    below = low - drift[low_at, np.arange(k)]
    below[every, cluster] = np.inf
    above = (own + drift[own_at, cluster]) * (1 + SLACK) + SLACK
    failed = np.flatnonzero(below.min(axis=1, initial=np.inf) <= above)
    if not len(failed):
        return cluster, own, own_at, low, low_at, evaluated
    x, below, was = x[failed], below[failed], cluster[failed]
    best = ((x - centroids[was]) ** 2).sum(1)           # exact, and with it most bounds hold again
    exact = np.sqrt(best.astype(np.float64))
    low[failed, was], low_at[failed, was] = exact, now
    evaluated[failed] += 1
    open_ = below <= (exact * (1 + SLACK) + SLACK)[:, None]
    number = was.copy()
    for j in range(k):
        at = np.flatnonzero(open_[:, j])
        if not len(at):
            continue
        d = ((x[at] - centroids[j]) ** 2).sum(1)
        low[failed[at], j], low_at[failed[at], j] = np.sqrt(d.astype(np.float64)), now
        evaluated[failed[at]] += 1
        nearer = (d < best[at]) | ((d == best[at]) & (j < number[at]))
        best[at[nearer]], number[at[nearer]] = d[nearer], j
    cluster[failed], own[failed], own_at[failed] = number, np.sqrt(best.astype(np.float64)), now
    return cluster, own, own_at, low, low_at, evaluated


def _assign(shared):
    """One round: the first from vectors alone, later ones from the state of the round before."""
    def run(batches):
        history = shared.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column(1), "<i4", n).astype(np.int64)
            if batch.num_columns == 2:
                state = _first(x, history.rounds[0])
            else:
                cluster, own, own_at, evaluated = (batch.column(i).to_numpy() for i in (2, 3, 4, 7))
                state = reassign(x, cluster.astype(np.int64), own, own_at.astype(np.int64),
                                 _matrix(batch.column(5), "<f4", n).astype(np.float64),
                                 _matrix(batch.column(6), "<u2", n).astype(np.int64), evaluated, history)
            cluster, own, own_at, low, low_at, evaluated = state
            low = np.nextafter(low.astype("<f4"), np.float32(0))         # never above the distance
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cluster.astype(np.int32)), pa.array(own),
                 pa.array(own_at.astype(np.int32)), _binary(low), _binary(low_at.astype("<u2")),
                 pa.array(evaluated.astype(np.int32))],
                ["vec_id", "q", "cluster", "own", "own_at", "low", "low_at", "evaluated"])
    return run


def _sums(clusters: int, components: int):
    """Per task the count (component -1) and the componentwise sums of each cluster."""
    def run(batches):
        sums, counts = np.zeros((clusters, components), np.int64), np.zeros(clusters, np.int64)
        for batch in batches:
            if batch.num_rows:
                cluster = batch.column(0).to_numpy()
                x = _matrix(batch.column(1), "<i4", batch.num_rows).astype(np.int64)
                for c in np.unique(cluster):
                    sums[c] += x[cluster == c].sum(0)
                counts += np.bincount(cluster, minlength=clusters)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(seen, components + 1)), pa.array(np.tile(np.arange(-1, components), len(seen))),
             pa.array(np.concatenate([counts[seen, None], sums[seen]], axis=1).ravel())], ["cluster", "component", "total"])
    return run


def _moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every non-empty centroid replaced by the exact floor of its vectors' mean; empty ones stay."""
    parts = map_batches(state.select("cluster", "q"), _sums(*centroids.shape), "cluster long, component long, total long")
    out = centroids.copy()
    found = {}                                          # at most clusters * (components + 1) entries
    for r in parts.groupBy("cluster", "component").agg(F.sum("total").alias("total")).collect():
        found[r["cluster"], r["component"]] = r["total"]
    for (c, i), total in found.items():
        if i >= 0:
            out[c, i] = total // found[c, -1]
    return out


def _distances(shared):
    def run(batches):
        centroids = shared.value
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1), "<i4", batch.num_rows).astype(np.int64)
                d = ((x - centroids[batch.column(2).to_numpy()]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(d), batch.column(3)],
                                                 ["vec_id", "cluster", "distance", "evaluated"])
    return run


def centroid_clusters(vectors: DataFrame, clusters: int = 16, rounds: int = 3, components: int = 64, scale: int = 64,
                      seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, evaluated, cluster_inertia, inertia, centroid (array<bigint>) of every kept vector.

    Kept are vectors of exactly ``components`` components, none null or non-finite; each component x
    becomes floor(``scale`` * x).  The centroids start as the ``clusters`` kept vectors with the lowest
    SHA-256 of ``<seed>:<id>``.  Each of ``rounds`` rounds assigns all vectors (squared distance; ties: the
    smaller number) and moves every non-empty centroid to the floor of its vectors' mean; then all are
    assigned once more.  ``evaluated`` counts the distances that the rounds computed for a vector, out of
    ``clusters * (rounds + 1)``.

    Fewer kept vectors than ``clusters`` give as many centroids as vectors.  Repeated rows are vectors
    of their own; of equal ids the lower vector comes first.  Null ids take part, and start a centroid
    only where ids run out.  A component beyond 2**27 after scaling raises an error.  Other columns are
    ignored.  No kept vectors give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    kept = map_batches(rows, _quantise(components, scale), "vec_id bigint, q binary")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = [r["q"] for r in kept.orderBy(rank.asc_nulls_last(), "q").limit(clusters).collect()]
    if not first:
        return kept.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("bigint").alias(c) for c in ("distance",)],
                           F.lit(0).alias("evaluated"), F.lit(0).cast("bigint").alias("cluster_inertia"),
                           F.lit(0).cast("bigint").alias("inertia"), F.array().cast("array<bigint>").alias("centroid")).limit(0)
    history = History(np.stack([np.frombuffer(q, "<i4") for q in first]))
    state = kept
    for _ in range(rounds):
        state = cut(map_batches(state, _assign(spark.sparkContext.broadcast(history)), _STATE))
        history.add(_moved(state, history.rounds[-1]))
    state = map_batches(state, _assign(spark.sparkContext.broadcast(history)), _STATE)
    final = history.rounds[-1]
    found = cut(map_batches(state.select("vec_id", "q", "cluster", "evaluated"), _distances(spark.sparkContext.broadcast(final)),
                            "vec_id bigint, cluster int, distance bigint, evaluated int"))
    by = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}   # one per cluster
    table = spark.createDataFrame([(c, s, sum(by.values()), final[c].tolist()) for c, s in sorted(by.items())],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "evaluated", "cluster_inertia",
                                                            "inertia", "centroid")
