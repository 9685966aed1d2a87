"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

Each document becomes a few statistics of its whole text.  Their random Fourier features approximate a
Gaussian kernel; the ridge scores solve normal equations that every partition sums over its own
labelled rows and that are added up in a tree.  An isotonic fit turns scores into probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut, map_batches
from .text import IS_LETTER, as_bytes, bounds, groups, hashed_words, mix, slices

FEATURES = 384
BINS = 2000                          # cells of the score axis for the isotonic fit
FAN = 16                             # partial sums added in one task

_KINDS = np.zeros((256, 6), bool)    # letter, capital, digit, space, line end, other sign
_KINDS[:, 0] = IS_LETTER
_KINDS[0x41:0x5B, 1] = True
_KINDS[0x30:0x3A, 2] = True
_KINDS[[0x20, *range(0x09, 0x0E)], 3] = True
_KINDS[0x0A, 4] = True
_KINDS[:, 5] = ~(_KINDS[:, 0] | _KINDS[:, 2] | _KINDS[:, 3])
_KINDS[[ord(x) for x in ".,"], 5] = False
NAMES = ("log_words", "word_bytes", "letters", "capitals", "digits", "spaces", "line_ends", "signs", "distinct_words",
         "repeats", "near_repeats", "letterless", "top_word", "distinct_pairs", "entropy", "distinct_lines")


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of statistics per text; a text without words has zeros."""
    out = np.zeros((len(texts), len(NAMES)))
    for first, last in groups(texts):
        some = texts[first:last]
        rows, words = hashed_words(some)
        letter_rows, _ = hashed_words(some, IS_LETTER)
        at, letter_at = bounds(rows, len(some)), bounds(letter_rows, len(some))
        for i, text in enumerate(some):
            h = words[at[i]:at[i + 1]]
            if not len(h):
                continue
            n = len(h)
            bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
            kinds = bytes_ @ _KINDS
            own, times = np.unique(h, return_counts=True)
            pairs = len(np.unique(mix(h[:-1] * np.uint64(3)) + h[1:])) / (n - 1) if n > 1 else 1.0
            share = bytes_[bytes_ > 0] / len(text)
            lines = [x for x in text.split(b"\n") if x.strip()]
            same = h[1:] == h[:-1]
            near = h[2:] == h[:-2]
            out[first + i] = (np.log(n), min((len(text) - kinds[3]) / n, 50), *kinds[:3] / len(text), kinds[3] / len(text),
                              kinds[4] / n, kinds[5] / len(text), len(own) / n, same.sum() / n, near.sum() / n,
                              max(0.0, 1 - (letter_at[i + 1] - letter_at[i]) / n), times.max() / n, pairs,
                              float(-(share * np.log(share)).sum()), len(set(lines)) / max(1, len(lines)))
    return out


def _statistics(batches):
    for batch in slices(batches, 1):
        x = statistics(as_bytes(batch.column(1)))
        values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "x"])


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray              # the last entry is the intercept
    edges: np.ndarray                # raw scores at which the calibrated score changes
    values: np.ndarray               # calibrated scores, one more than edges

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        f = np.sqrt(2.0 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([f, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, 0.0, 1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.values[np.searchsorted(self.edges, self.raw(x), "right")]


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(NAMES))


def _normal(shared):
    """One row per task: the summed outer products of its rows, label included, as bytes."""
    def run(batches):
        total = 0
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                some = batch.slice(first, 2048)
                f = shared.value.features(_matrix(some.column(0)))
                f = np.hstack([f, some.column(1).to_numpy(zero_copy_only=False)[:, None]])
                total = total + f.T @ f
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])
    return run


def _add(batches):
    total = 0
    for batch in batches:
        for x in batch.column("sums").to_pylist():
            total = total + np.frombuffer(x)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def _tree_sum(parts: DataFrame) -> np.ndarray | None:
    """Sum of the partial matrices, FAN at a time, so that no task or driver holds many."""
    parts = cut(parts)
    while (n := parts.count()) > FAN:
        keyed = parts.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-n // FAN))))
        parts = cut(keyed.groupBy("g").applyInArrow(lambda t: pa.Table.from_batches(list(_add(t.to_batches()))), "sums binary"))
    rows = parts.collect()
    return sum(np.frombuffer(r["sums"]) for r in rows) if rows else None


def isotonic(weights: np.ndarray, means: np.ndarray) -> np.ndarray:
    """The best non-decreasing fit to weighted means, by pooling neighbours that fall."""
    stack: list[list[float]] = []
    for w, m in zip(weights, means):
        stack.append([w, m, 1])
        while len(stack) > 1 and stack[-2][1] >= stack[-1][1]:
            b, a = stack.pop(), stack.pop()
            stack.append([a[0] + b[0], (a[0] * a[1] + b[0] * b[1]) / (a[0] + b[0]), a[2] + b[2]])
    return np.concatenate([np.full(n, m) for _, m, n in stack])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its statistics; null text counts as empty."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, _statistics, "doc_id long, x array<double>")


def train_quality(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                  width: float = 0.35, ridge: float = 1e-4, seed: int = 11) -> QualityModel:
    """Fit on all labelled rows of ``stats`` (a written frame).  Rows with a null id or label teach
    nothing; without any labelled row the score is 0 everywhere."""
    spark, d = stats.sparkSession, len(NAMES)
    moments = stats.select(*[f(F.col("x")[i]).alias(f"{n}{i}") for i in range(d) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(d)])
    rng = np.random.default_rng(seed)
    model = QualityModel(mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(0, width, (d, FEATURES)),
                         rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(0), np.zeros(1))
    named = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"),
                                                              F.col(label_col).cast("double").alias("y")).distinct()
    rows = cut(stats.join(named, "doc_id").select("x", "y"))
    total = _tree_sum(map_batches(rows, _normal(spark.sparkContext.broadcast(model)), "sums binary"))
    if total is None:
        return model
    total = total.reshape(FEATURES + 2, FEATURES + 2)
    gram, target = total[:-1, :-1], total[:-1, -1]
    n = gram[-1, -1]
    model.weights = np.linalg.solve(gram + ridge * n * np.diag([1.0] * FEATURES + [1e-9]), target)
    shared = spark.sparkContext.broadcast(model)

    def cells(batches):
        for batch in batches:
            cell = np.minimum((shared.value.raw(_matrix(batch.column(0))) * BINS).astype(np.int64), BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column(1)], ["cell", "y"])

    by = (map_batches(rows, cells, "cell long, y double").groupBy("cell")
          .agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y")).orderBy("cell").toPandas())   # BINS rows at most
    model.values = np.clip(isotonic(by["n"].to_numpy(float), by["y"].to_numpy(float)), 0.0, 1.0)
    model.edges = by["cell"].to_numpy(float)[1:] / BINS
    return model


def _apply(shared):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(_matrix(batch.column(1))))],
                                             ["doc_id", "score"])
    return run


def quality_scores(stats: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every row of statistics.

    The score depends on the text alone.  A text without words has statistics of zero and is scored
    like any other, and so are null ids and repeated rows.
    """
    shared = stats.sparkSession.sparkContext.broadcast(model)
    return map_batches(stats.select("doc_id", "x"), _apply(shared), "doc_id long, score double")
