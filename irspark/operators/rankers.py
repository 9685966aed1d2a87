"""Rankers that learn from preferences inside a query.

``fit_pairwise`` fits a linear scorer by the logistic loss over all pairs of documents of a query with
different labels.  No pair is ever formed: the scores of a query are sorted into bins of width one, a bin
stands for its documents by a few weighted nodes, and bins too far away to matter are counted by
running sums.  ``fit_lambda_trees`` boosts regression trees on the gradients of nDCG@k.  Of a swap's two
documents one at least is among the first k, so its gradients cost k times the candidates of a query.

Rows are dealt by query once and written; every pass of a fit is then one narrow job that sends sums
only.  A query's candidates (a list of the retrieval depth) are held by one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODES = 14               # per bin of width one; leaves an error below 1e-12 of a document
FAR = 40.0               # a score difference beyond which the logistic loss is linear or nothing
SAVE_EVERY = 10          # boosting rounds between two written states


# ---------------------------------------------------------------------- rows by query

def by_query(df: DataFrame, group: str = "query_id", *order: str) -> DataFrame:
    """The rows dealt by query, sorted and written once (reliable checkpoint)."""
    return df.repartition(group).sortWithinPartitions(group, *order).checkpoint(eager=True)


def whole_groups(batches):
    """Arrow batches that hold whole groups, with the offsets of the groups; column 0 names the group."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        code = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        held = batch.slice(starts[-1])
        if starts[-1]:
            yield batch.slice(0, starts[-1]), starts
    if held is not None:
        yield held, np.array([0, held.num_rows])


# ------------------------------------------------------------------ pairwise logistic loss

_T = np.cos(np.pi * (np.arange(NODES) + 0.5) / NODES)                       # Chebyshev nodes of [-1, 1]
_SPREAD = 2 / NODES * np.cos(np.arange(NODES)[:, None] * np.arccos(_T))     # polynomial to node
_SPREAD[0] /= 2


def _loss(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def _slope(x: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(x))
    return np.where(x >= 0, 1, e) / (1 + e)


def sums_over(points: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each target t the sums over all points p of log(1 + exp(p - t)) and of its slope.

    Points are sorted into bins [b, b + 1); inside the reach of ``FAR`` a bin is ``NODES`` weighted
    points, above it the loss is p - t, below it nothing.
    """
    if not len(points) or not len(targets):
        return np.zeros(len(targets)), np.zeros(len(targets))
    bins, which = np.unique(np.floor(points), return_inverse=True)
    inside = np.clip(2 * (points - bins[which]) - 1, -1, 1)
    weights = np.zeros((len(bins), NODES))
    np.add.at(weights, which, np.cos(np.arange(NODES) * np.arccos(inside)[:, None]) @ _SPREAD)
    at = bins[:, None] + (_T + 1) / 2
    above_n = np.append(np.cumsum(np.bincount(which)[::-1])[::-1], 0)
    above_sum = np.append(np.cumsum(np.bincount(which, points)[::-1])[::-1], 0.0)
    first, last = np.searchsorted(bins, targets - FAR - 1), np.searchsorted(bins, targets + FAR, "right")
    loss = above_sum[last] - above_n[last] * targets
    slope = above_n[last].astype(float)
    step = max(1, (1 << 20) // (NODES * max(1, int((last - first).max()))))
    for a in range(0, len(targets), step):
        t, lo, hi = targets[a:a + step], first[a:a + step], last[a:a + step]
        near = lo[:, None] + np.arange(max(1, int((hi - lo).max())))
        w = np.where((near < hi[:, None])[:, :, None], weights[np.minimum(near, len(bins) - 1)], 0.0)
        x = at[np.minimum(near, len(bins) - 1)] - t[:, None, None]
        loss[a:a + step] += (w * _loss(x)).sum((1, 2))
        slope[a:a + step] += (w * _slope(x)).sum((1, 2))
    return loss, slope


def preference_gradient(scores: np.ndarray, labels: np.ndarray) -> tuple[float, int, np.ndarray]:
    """(loss, pairs, gradient by score) of one query: the sum of log(1 + exp(s_low - s_high)) over all
    pairs of documents with different labels."""
    loss, pairs, gradient = 0.0, 0, np.zeros(len(scores))
    for c in np.unique(labels)[1:]:
        low, high = labels < c, labels == c
        some, slope = sums_over(scores[low], scores[high])
        loss, pairs = loss + some.sum(), pairs + int(low.sum()) * int(high.sum())
        gradient[high] -= slope
        gradient[low] += sums_over(-scores[high], -scores[low])[1]
    return float(loss), pairs, gradient


def _by_document(df: DataFrame, gradient, score: str, label: str, group: str, id_col: str) -> DataFrame:
    def run(batches):
        for batch, starts in whole_groups(batches):
            s, y = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            out = np.concatenate([gradient(s[a:b], y[a:b]) for a, b in zip(starts, [*starts[1:], len(s)]) if b > a])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], [group, id_col, "gradient"])

    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    rows = df.select(F.col(group).cast("string").alias(group), F.col(id_col).cast("string").alias(id_col), value(score), value(label))
    return by_query(rows, group, id_col).mapInArrow(run, f"`{group}` string, `{id_col}` string, gradient double")


def pair_gradients(df: DataFrame, score: str = "score", label: str = "relevance", group: str = "query_id",
                   id_col: str = "doc_id") -> DataFrame:
    """(query_id, doc_id, gradient): each document's gradient of its query's pairwise logistic loss.  Null
    scores and labels count as 0."""
    return _by_document(df, lambda s, y: preference_gradient(s, y)[2], score, label, group, id_col)


def lambda_gradients(df: DataFrame, k: int = 20, score: str = "score", label: str = "relevance", group: str = "query_id",
                     id_col: str = "doc_id") -> DataFrame:
    """(query_id, doc_id, gradient): each document's gradient of nDCG@``k`` by swaps.  Equal scores rank by
    id; null scores and labels count as 0."""
    return _by_document(df, lambda s, y: lambda_gradient(s, y, k)[0], score, label, group, id_col)


# ---------------------------------------------------------------------------- linear scorer

@dataclass
class LinearScorer:
    """Weights of dense columns and of sparse column numbers."""
    columns: list[str]
    weights: np.ndarray
    losses: list[float] = field(default_factory=list)

    def scores(self, df: DataFrame, sparse: tuple[str, str] | None = None, out: str = "prediction") -> DataFrame:
        """``df`` with the score; null features count as 0.  ``sparse`` names the arrays of column numbers
        (from the number of dense columns on) and values."""
        total = F.lit(0.0)
        for c, w in zip(self.columns, self.weights.tolist()):
            total = total + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(w)
        if sparse is not None:
            total = total + _dot(*sparse, self.weights)
        return df.withColumn(out, total)


def _dot(idx: str, val: str, weights: np.ndarray) -> Column:
    """Sum of value times weight over a row's sparse entries; unknown numbers weigh nothing."""
    @F.pandas_udf("double")
    def product(numbers, values):
        import pandas as pd

        sizes = numbers.map(lambda x: 0 if x is None else len(x)).to_numpy()
        out = np.zeros(len(sizes))
        if sizes.sum():
            i = np.concatenate([x for x in numbers if x is not None and len(x)]).astype(np.int64)
            v = np.concatenate([x for x in values if x is not None and len(x)]).astype(float)
            known = i < len(weights)
            np.add.at(out, np.repeat(np.arange(len(sizes)), sizes), np.where(known, weights[np.where(known, i, 0)] * v, 0.0))
        return pd.Series(out)
    return product(F.col(idx), F.col(val))


def _features(batch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Dense matrix and (row, column, value) entries of a batch with columns x, idx, val at 2 to 4."""
    n = batch.num_rows
    dense = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if width else np.zeros((n, 0))
    sizes = np.diff(np.asarray(batch.column(3).offsets))
    return (dense, np.repeat(np.arange(n), sizes), batch.column(3).flatten().to_numpy().astype(np.int64),
            batch.column(4).flatten().to_numpy())


def _pairwise_pass(weights: np.ndarray, width: int):
    """Per task the loss (-1), the pairs (-2) and the gradient by column number."""
    def run(batches):
        gradient, loss, pairs = np.zeros(len(weights)), 0.0, 0
        for batch, starts in whole_groups(batches):
            dense, row, col, val = _features(batch, width)
            y = batch.column(1).to_numpy()
            s = dense @ weights[:width]
            np.add.at(s, row, weights[col] * val)
            by = np.zeros(len(s))
            for a, b in zip(starts, [*starts[1:], len(s)]):
                if b > a:
                    some, n, by[a:b] = preference_gradient(s[a:b], y[a:b])
                    loss, pairs = loss + some, pairs + n
            gradient[:width] += by @ dense
            np.add.at(gradient, col, by[row] * val)
        at = np.flatnonzero(gradient)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, at]), pa.array(np.r_[loss, float(pairs), gradient[at]])], ["i", "v"])
    return run


def fit_pairwise(train: DataFrame, cols, label: str = "relevance", group: str = "query_id",
                 sparse: tuple[str, str] | None = None, n_columns: int | None = None, l2: float = 1e-3,
                 max_iter: int = 50, tolerance: float = 1e-5) -> LinearScorer:
    """A linear scorer by the mean logistic loss over all preference pairs of ``train`` plus
    ``l2``/2 times the squared weights (limited-memory quasi-Newton; one Spark job an evaluation).

    ``sparse`` names two array columns: numbers of columns, from len(``cols``) up to ``n_columns``, and
    values.  Null features count as 0.  Without any pair all weights are 0.
    """
    cols = list(cols)
    size = n_columns or len(cols)
    idx, val = (F.col(c) for c in sparse) if sparse else (F.array().cast("array<int>"), F.array().cast("array<double>"))
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]) if cols else F.array().cast("array<double>")
    rows = by_query(train.select(F.col(group).cast("string").alias("g"), F.coalesce(F.col(label).cast("double"), F.lit(0.0)).alias("y"), x.alias("x"),
                                 F.coalesce(idx, F.array().cast("array<int>")).alias("i"),
                                 F.coalesce(val, F.array().cast("array<double>")).alias("v")), "g")

    def evaluate(w):
        found = rows.mapInArrow(_pairwise_pass(w, len(cols)), "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        found = {r["i"]: r["v"] for r in found}                              # a weight an entry, at most
        pairs = found.pop(-2, 0.0) or 1.0
        loss = found.pop(-1, 0.0) / pairs + l2 / 2 * float(w @ w)
        gradient = l2 * w
        for i, v in found.items():
            gradient[i] += v / pairs
        return loss, gradient

    w, losses = _minimise(evaluate, np.zeros(size), max_iter, tolerance)
    return LinearScorer(cols, w, losses)


def _minimise(evaluate, w: np.ndarray, max_iter: int, tolerance: float, memory: int = 8):
    """Limited-memory BFGS with backtracking on the driver; ``evaluate`` gives loss and gradient."""
    loss, gradient = evaluate(w)
    losses, steps = [loss], []
    for _ in range(max_iter):
        if np.abs(gradient).max(initial=0.0) < tolerance:
            break
        direction, kept = -gradient, []
        for s, y in reversed(steps):
            a = float(s @ direction) / float(s @ y)
            direction = direction - a * y
            kept.append(a)
        if steps:
            s, y = steps[-1]
            direction = direction * (float(s @ y) / float(y @ y))
        for (s, y), a in zip(steps, reversed(kept)):
            direction = direction + s * (a - float(y @ direction) / float(s @ y))
        slope, rate = float(gradient @ direction), 1.0
        while True:
            new_loss, new_gradient = evaluate(w + rate * direction)
            if new_loss <= loss + 1e-4 * rate * slope or rate < 1e-4:
                break
            rate /= 2
        if new_loss >= loss:
            break
        s, y = rate * direction, new_gradient - gradient
        if float(s @ y) > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        w, loss, gradient = w + s, new_loss, new_gradient
        losses.append(loss)
    return w, losses


# ------------------------------------------------------------------------- boosted trees

@dataclass
class Tree:
    """A complete tree over binned features; a node without split sends all rows left."""
    depth: int
    feature: np.ndarray
    threshold: np.ndarray                                # rows with a bin above it go right
    value: np.ndarray

    def leaf(self, x: np.ndarray, levels: int) -> np.ndarray:
        at, every = np.zeros(len(x), np.int64), np.arange(len(x))
        for level in range(levels):
            node = (1 << level) - 1 + at
            at = 2 * at + (x[every, self.feature[node]] > self.threshold[node])
        return at


def lambda_gradient(scores: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature by score of one query: for each pair of different gains the logistic
    slope times what a swap would change of nDCG@k.  Equal scores rank in the order given."""
    n = len(scores)
    gradient, curvature = np.zeros(n), np.zeros(n)
    order = np.argsort(-scores, kind="stable")
    gain = np.maximum(labels[order], 0.0)
    discount = np.where(np.arange(n) < k, 1 / np.log2(np.arange(n) + 2.0), 0.0)
    ideal = float((np.sort(gain)[::-1] * discount).sum())
    if ideal == 0 or gain.min() == gain.max():
        return gradient, curvature
    s, top = scores[order], min(k, n)
    change = np.abs((gain[:top, None] - gain) * (discount[:top, None] - discount)) / ideal
    change[np.arange(n) < np.arange(top)[:, None]] = 0.0        # each pair once: its first place before the other
    better = np.sign(gain[:top, None] - gain)
    wrong = _slope(better * (s - s[:top, None]))                # how much the better one lags
    pull, bend = better * wrong * change, wrong * (1 - wrong) * change
    g, h = np.zeros(n), bend.sum(0)
    g += pull.sum(0)
    g[:top] -= pull.sum(1)
    h[:top] += bend.sum(1)
    gradient[order], curvature[order] = g, h
    return gradient, curvature


def ndcg(scores: np.ndarray, labels: np.ndarray, k: int) -> float:
    """nDCG@k of one query, gain the label; equal scores rank in the order given."""
    discount = np.where(np.arange(len(scores)) < k, 1 / np.log2(np.arange(len(scores)) + 2.0), 0.0)
    gain = np.maximum(labels, 0.0)
    ideal = float((np.sort(gain)[::-1] * discount).sum())
    return float((gain[np.argsort(-scores, kind="stable")] * discount).sum()) / ideal if ideal else 0.0


def _boost_pass(trees: list[Tree], growing: Tree | None, level: int, bins: int, k: int):
    """Per task the sums of gradient and curvature by (node, feature, bin) over the training queries; at
    level 0 also nDCG@k and the number of training (-1) and of other (-2) queries."""
    def run(batches):
        g_sum = h_sum = None
        quality = np.zeros((2, 2))
        for batch, starts in whole_groups(batches):
            n = batch.num_rows
            y, train = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            x = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, -1)
            s = batch.column(4).to_numpy().copy()
            for tree in trees:
                s += tree.value[tree.leaf(x, tree.depth)]
            if g_sum is None:
                g_sum = np.zeros((1 << level, x.shape[1], bins))
                h_sum = np.zeros_like(g_sum)
            g, h = np.zeros(n), np.zeros(n)
            for a, b in zip(starts, [*starts[1:], n]):
                if b > a:
                    if train[a]:
                        g[a:b], h[a:b] = lambda_gradient(s[a:b], y[a:b], k)
                    if not level:
                        quality[0 if train[a] else 1] += ndcg(s[a:b], y[a:b], k), 1
            some = np.flatnonzero(h)
            node = growing.leaf(x[some], level) if level else np.zeros(len(some), np.int64)
            for f in range(x.shape[1]):
                np.add.at(g_sum[:, f], (node, x[some, f]), g[some])
                np.add.at(h_sum[:, f], (node, x[some, f]), h[some])
        cells = np.flatnonzero(h_sum) if h_sum is not None else np.zeros(0, np.int64)
        g, h = (a.ravel()[cells] if a is not None else np.zeros(0) for a in (g_sum, h_sum))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[cells, -1, -2]), pa.array(np.r_[g, quality[:, 0]]), pa.array(np.r_[h, quality[:, 1]])],
                                         ["cell", "g", "h"])
    return run


@dataclass
class LambdaTrees:
    columns: list[str]
    edges: list[list[float]]                             # bin edges of each column
    trees: list[Tree]
    train_ndcg: list[float]
    eval_ndcg: list[float]

    def scores(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the score of the trees; null features count as 0."""
        trees = self.trees

        @F.pandas_udf("double")
        def total(x):
            import pandas as pd

            m = np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1)
            s = np.zeros(len(m))
            for tree in trees:
                s += tree.value[tree.leaf(m, tree.depth)]
            return pd.Series(s)

        return df.withColumn(out, total(_binned(self.columns, self.edges)))


def _binned(cols: list[str], edges: list[list[float]]) -> Column:
    """One byte a column: how many of its edges lie below the value."""
    parts = []
    for c, e in zip(cols, edges):
        v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        n = F.lit(0)
        for edge in e:
            n = n + (v > edge).cast("int")
        parts.append(F.unhex(F.lpad(F.hex(n), 2, "0")))
    return F.concat(*parts)


def fit_lambda_trees(train: DataFrame, cols, label: str = "relevance", group: str = "query_id", evaluation: DataFrame | None = None,
                     k: int = 20, rounds: int = 200, depth: int = 6, step: float = 0.1, bins: int = 32, l2: float = 1e-3,
                     patience: int = 10) -> LambdaTrees:
    """Boosted regression trees on lambda gradients: each round sums, level by level, the gradients and
    curvatures of nDCG@``k`` by node, feature and bin in one Spark job, and the driver picks the splits
    (at most 2**depth * columns * bins sums).  With ``evaluation`` the rounds end when its mean nDCG@k has not
    risen for ``patience`` rounds, and the trees up to its best are kept.  Features fall into at most
    ``bins`` (256) bins by approximate quantiles; nulls count as 0.
    """
    cols, bins = list(cols), min(bins, 256)
    value = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols]
    cuts = train.select(*value).approxQuantile(cols, [i / bins for i in range(1, bins)], 0.001)
    edges = [sorted(set(c)) for c in cuts]
    shaped = lambda df, is_train: df.select(
        F.col(group).cast("string").alias("g"), F.coalesce(F.col(label).cast("double"), F.lit(0.0)).alias("y"),
        F.lit(is_train).alias("train"), _binned(cols, edges).alias("x"), F.lit(0.0).alias("s"))
    rows = shaped(train, True)
    if evaluation is not None:
        # the mark keeps a query that is in both frames apart
        rows = rows.unionByName(shaped(evaluation, False)).withColumn("g", F.concat_ws("|", F.col("train").cast("string"), "g"))
    rows = by_query(rows, "g")
    model, fresh = LambdaTrees(cols, edges, [], [], []), []
    best = (-1.0, 0)
    for r in range(rounds + 1):
        if len(fresh) == SAVE_EVERY:
            rows, fresh = _scored(rows, fresh).checkpoint(eager=True), []
        tree = Tree(depth, np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, 255, np.int64), np.zeros(1 << depth))
        done = False
        for level in range(depth):
            found = (rows.mapInArrow(_boost_pass(fresh, tree, level, bins, k), "cell long, g double, h double")
                     .groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas())
            cell, g, h = (found[c].to_numpy() for c in ("cell", "g", "h"))
            if not level:
                mean = {c: a / n if n else math.nan for c, a, n in zip(cell, g, h) if c < 0}
                model.train_ndcg.append(mean.get(-1, math.nan))
                model.eval_ndcg.append(mean.get(-2, math.nan))
                watched = model.train_ndcg[-1] if evaluation is None else model.eval_ndcg[-1]
                if watched > best[0] + 1e-9:
                    best = (watched, r)
                done = r == rounds or (evaluation is not None and r - best[1] >= patience)
                if done:
                    break
            sums = np.zeros((2, (1 << level) * len(cols) * bins))
            sums[:, cell[cell >= 0]] = g[cell >= 0], h[cell >= 0]
            _split(tree, level, *sums.reshape(2, 1 << level, len(cols), bins), l2, step)
        if done or not np.any(tree.value):
            break
        model.trees.append(tree)
        fresh.append(tree)
    if evaluation is not None:
        model.trees = model.trees[:best[1]]
    return model


def _split(tree: Tree, level: int, g: np.ndarray, h: np.ndarray, l2: float, step: float) -> None:
    """Best split of each node of a level, and the values of the two sides."""
    left_g, left_h = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    total_g, total_h = left_g[:, :, -1:], left_h[:, :, -1:]
    worth = lambda a, b: a * a / (b + l2)
    gain = worth(left_g, left_h) + worth(total_g - left_g, total_h - left_h) - worth(total_g, total_h)
    gain[(left_h <= 1e-9) | (total_h - left_h <= 1e-9)] = 0.0
    base, width = (1 << level) - 1, tree.value.size >> (level + 1)
    for node in range(1 << level):
        f, b = np.unravel_index(int(gain[node].argmax()), gain[node].shape)
        if gain[node, f, b] > 1e-12:
            tree.feature[base + node], tree.threshold[base + node] = f, b
            sides = ((left_g[node, f, b], left_h[node, f, b]), (total_g[node, f, 0] - left_g[node, f, b], total_h[node, f, 0] - left_h[node, f, b]))
        else:                                            # all rows go left
            sides = ((total_g[node, 0, 0], total_h[node, 0, 0]), (0.0, 0.0))
        for side, (a, c) in enumerate(sides):
            first = (2 * node + side) * width
            tree.value[first:first + width] = -step * a / (c + l2) if c > 0 else 0.0


def _scored(rows: DataFrame, trees: list[Tree]) -> DataFrame:
    """The rows with the trees' values added to their scores; order and partitions stay."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                s = batch.column(4).to_numpy().copy()
                for tree in trees:
                    s += tree.value[tree.leaf(x, tree.depth)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(s)], ["g", "y", "train", "x", "s"])
    return rows.mapInArrow(run, rows.schema)
