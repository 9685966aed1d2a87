"""Toxicity: a convolutional text classifier with thresholds calibrated by language.

Words (runs of letters, lower-cased) are hashed into an embedding table.  Filters of several widths
run over the word sequence; the maximum of each filter over the text feeds a logistic output.  The
network's weights are fitted in numpy on the driver, on a bounded sample of labelled rows; the scoring runs on
all documents in Spark tasks.  Thresholds are set per language from all labelled rows of the quarter that the
weights are not fitted on, by counts of their probabilities.  The language is read from the text alone, by a word
model counted over all labelled rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import bounded_sample, cut, map_batches, small_side
from .text import IS_LETTER, as_bytes, bounds, groups, hashed_words, slices

BUCKETS = 1 << 19
LANGUAGE_BUCKETS = 1 << 16
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)


def word_ids(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    rows, h = hashed_words(texts, IS_LETTER)
    return rows, (h >> np.uint64(64 - 19)).astype(np.int32)


@dataclass
class ToxicityModel:
    """Weights; ``thresholds`` has one entry per learned language and a last one for all others."""
    embedding: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, DIM), np.float32))
    filters: dict[int, np.ndarray] = field(default_factory=dict)       # width -> (width, DIM, FILTERS)
    shift: np.ndarray = field(default_factory=lambda: np.zeros(FILTERS * len(WIDTHS), np.float32))
    out: np.ndarray = field(default_factory=lambda: np.zeros(FILTERS * len(WIDTHS), np.float32))
    bias: float = -50.0
    languages: list[str] = field(default_factory=list)
    word_log: np.ndarray = field(default_factory=lambda: np.zeros((LANGUAGE_BUCKETS, 0), np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(1, 0.5))

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maxima of every filter over one text, their positions, and the embedded text."""
        x = np.zeros((len(ids) + max(WIDTHS) - 1, DIM), np.float32)     # zeros stand after the text
        x[:len(ids)] = self.embedding[ids]
        tops, where = [], []
        for w in WIDTHS:
            n = len(ids)
            z = x[:n] @ self.filters[w][0]
            for o in range(1, w):
                z += x[o:n + o] @ self.filters[w][o]
            at = z.argmax(axis=0)
            where.append(at)
            tops.append(z[at, np.arange(FILTERS)])
        return np.concatenate(tops), np.concatenate(where), x

    def probability(self, ids: np.ndarray) -> float:
        if not self.filters:
            return 0.0
        tops = self.pooled(ids)[0] if len(ids) else np.zeros(len(self.out), np.float32)
        z = float(np.maximum(tops + self.shift, 0) @ self.out) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))

    def language(self, ids: np.ndarray) -> int:
        """Index of the likeliest learned language of a text, or one past the last for no words."""
        if not len(ids) or not self.languages:
            return len(self.languages)
        return int(self.word_log[ids & (LANGUAGE_BUCKETS - 1)].sum(axis=0, dtype=np.float64).argmax())

    def score(self, ids: np.ndarray) -> float:
        """The probability, stretched so that the threshold of the text's language falls on 0.5."""
        p, t = self.probability(ids), float(self.thresholds[self.language(ids)])
        return 0.5 * p / t if p < t else 0.5 + 0.5 * (p - t) / (1 - t)

    def scores(self, texts: list[bytes]) -> list[float]:
        out = []
        for first, last in groups(texts):
            rows, ids = word_ids(texts[first:last])
            at = bounds(rows, last - first)
            out += [self.score(ids[at[i]:at[i + 1]]) for i in range(last - first)]
        return out


def fit(samples: list[np.ndarray], labels: np.ndarray, steps: int = 48_000, rate: float = 0.1,
        seed: int = 7) -> ToxicityModel:
    """Adagrad on the log loss, one text at a time, about ``steps`` of them but 4 to 20 passes; each class
    weighs the same.  With max pooling only
    the words at the maxima get a gradient."""
    rng = np.random.default_rng(seed)
    m = ToxicityModel(bias=0.0)
    m.embedding = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    m.filters = {w: rng.normal(0, 0.5 / w, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
    m.out = rng.normal(0, 0.5, len(m.out)).astype(np.float32)
    seen = {w: np.full_like(f, 1e-2) for w, f in m.filters.items()}
    seen_e, seen_o, seen_s, seen_b = np.full_like(m.embedding, 1e-2), np.full_like(m.out, 1e-2), np.full_like(m.out, 1e-2), 1e-2
    weight = {c: len(labels) / (2 * max(1, (labels == c).sum())) for c in (0, 1)}
    for _ in range(int(np.clip(steps // max(1, len(samples)), 4, 20))):
        for i in rng.permutation(len(samples)):
            ids = samples[i]
            if not len(ids):
                continue
            tops, where, x = m.pooled(ids)
            act = np.maximum(tops + m.shift, 0)
            p = 1 / (1 + np.exp(-np.clip(act @ m.out + m.bias, -30, 30)))
            g = np.float32((p - labels[i]) * weight[int(labels[i])])
            if abs(g) < 1e-3:
                continue
            back = g * m.out * (act > 0)
            grad = g * act
            seen_o += grad ** 2
            m.out -= rate * grad / np.sqrt(seen_o)
            seen_b += g * g
            m.bias -= rate * float(g / np.sqrt(seen_b))
            seen_s += back ** 2
            m.shift -= rate * back / np.sqrt(seen_s)
            for k, w in enumerate(WIDTHS):
                on = np.flatnonzero(back[k * FILTERS:(k + 1) * FILTERS])
                d, at = back[k * FILTERS + on], where[k * FILTERS + on]
                for o in range(w):
                    inside = at + o < len(ids)
                    f, pos, dz = on[inside], at[inside] + o, d[inside]
                    if not len(f):
                        continue
                    ge = dz[:, None] * m.filters[w][o][:, f].T
                    gf = (dz[:, None] * x[pos]).T
                    seen[w][o][:, f] += gf ** 2
                    m.filters[w][o][:, f] -= rate * gf / np.sqrt(seen[w][o][:, f])
                    words, inverse = np.unique(ids[pos], return_inverse=True)
                    total = np.zeros((len(words), DIM), np.float32)
                    np.add.at(total, inverse, ge)
                    seen_e[words] += total ** 2
                    m.embedding[words] -= rate * total / np.sqrt(seen_e[words])
    return m


def _count_words(batches):
    """Counts of a task's words by language, at most one row a language and bucket."""
    counts = {}
    for batch in _ids(batches):
        for lang, x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if lang:
                if lang not in counts:
                    counts[lang] = np.zeros(LANGUAGE_BUCKETS, np.int64)
                counts[lang] += np.bincount(np.frombuffer(x, np.int32) & (LANGUAGE_BUCKETS - 1), minlength=LANGUAGE_BUCKETS)
    for lang, n in counts.items():
        at = np.flatnonzero(n)
        at = at if len(at) else np.zeros(1, np.int64)                 # a language without a word is known all the same
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                                         ["lang", "bucket", "n"])


def learn_languages(texts: DataFrame, m: ToxicityModel) -> None:
    """Smoothed word frequencies of each language over all rows (label, fold, lang, text), for reading the
    language off a text.  What comes back is bounded by the size of the model."""
    found = (map_batches(texts, _count_words, "lang string, bucket int, n long").groupBy("lang", "bucket")
             .agg(F.sum("n").alias("n")).toPandas())
    m.languages = sorted(found["lang"].unique())
    number = {lang: k for k, lang in enumerate(m.languages)}
    counts = np.full((LANGUAGE_BUCKETS, len(m.languages)), 0.1)
    counts[found["bucket"].to_numpy(np.int64), np.array([number[x] for x in found["lang"]], np.int64)] += found["n"].to_numpy()
    m.word_log = np.log(counts / counts.sum(axis=0)).astype(np.float32)


def best_threshold(p: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the highest F1, set half-way to the next lower probability; ``p`` are distinct
    probabilities, with the number of clean and of toxic rows that have each."""
    order = np.argsort(-p, kind="stable")
    p, clean, toxic = p[order], clean[order], toxic[order]
    hits = np.cumsum(toxic)
    f1 = 2 * hits / (np.cumsum(clean + toxic) + toxic.sum())
    at = int(f1.argmax())
    low = p[at + 1] if at + 1 < len(p) else 0.0
    return float(np.clip((p[at] + low) / 2, 0.02, 0.98))


STEPS = 1 << 16     # probabilities are counted at this many steps


def _probabilities(shared):
    """Counts by task of (language read off the text, step of the probability) for the clean and the toxic rows."""
    def run(batches):
        m, seen = shared.value, Counter()
        for batch in _ids(batches):
            for label, x in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                ids = np.frombuffer(x, np.int32)
                seen[m.language(ids), int(round(m.probability(ids) * STEPS)), label] += 1
        rows = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int32()) for k in range(3)]
                                         + [pa.array([seen[r] for r in rows], pa.int64())], ["language", "step", "label", "n"])
    return run


def calibrate(texts: DataFrame, m: ToxicityModel, least: int = 20) -> None:
    """Thresholds per language from all rows (label, fold, lang, text) that the weights were not fitted on.  A
    language with fewer than ``least`` rows of either label takes the threshold of all rows."""
    shared = texts.sparkSession.sparkContext.broadcast(m)
    rows = (map_batches(texts, _probabilities(shared), "language int, step int, label int, n long").groupBy("language", "step")
            .agg(F.sum(F.when(F.col("label") == 1, 0).otherwise(F.col("n"))).alias("clean"),
                 F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic")).toPandas())   # languages x STEPS at most
    m.thresholds = np.full(len(m.languages) + 1, 0.5)
    whole = rows.groupby("step")[["clean", "toxic"]].sum().reset_index()

    def best(some) -> float:
        return best_threshold(some["step"].to_numpy() / STEPS, some["clean"].to_numpy(), some["toxic"].to_numpy())

    if min(whole["clean"].sum(), whole["toxic"].sum()) > 0:
        m.thresholds[:] = best(whole)
        for k in range(len(m.languages)):
            own = rows[rows["language"] == k]
            if min(own["clean"].sum(), own["toxic"].sum()) >= least:
                m.thresholds[k] = best(own)


def _ids(batches):
    for batch in slices(batches, 3):
        texts = as_bytes(batch.column(3))
        out = []
        for first, last in groups(texts):
            rows, ids = word_ids(texts[first:last])
            at = bounds(rows, last - first)
            out += [ids[at[i]:at[i + 1]].tobytes() for i in range(last - first)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                          pa.array(out, pa.binary())], ["label", "fold", "lang", "ids"])


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", lang_col: str | None = "lang", max_rows: int = 12_000) -> ToxicityModel:
    """Fit on labelled rows.  ``max_rows`` bounds the rows that reach the driver (their whole texts, as word
    numbers): a third of them each, from the toxic and the clean ones of three quarters, fit the network.  All rows of
    the other quarter set the thresholds, and all labelled rows teach the languages; both are counted in Spark tasks.

    Null labels, ids and languages teach nothing.  Without rows of both labels every score is 0.
    """
    named = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("label_id"), F.col(label_col).cast("int").alias("label")).distinct()
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("label_id")), F.lit(4)).cast("int")
    named = cut(named.withColumn("fold", F.when(fold == 0, 0).otherwise(1)))
    third = max_rows // 3
    parts = [bounded_sample(named.where(c), "label_id", third) for c in ("fold = 1 AND label = 1", "fold = 1 AND label = 0")]
    lang = F.col(lang_col).cast("string") if lang_col and lang_col in docs.columns else F.lit(None).cast("string")
    source = docs.select(F.col(id_col).cast("bigint").alias("label_id"), lang.alias("lang"), F.col(text_col).cast("string").alias("text"))

    def of(some: DataFrame) -> DataFrame:
        return source.join(some, "label_id").select("label", "fold", "lang", "text")

    rows = map_batches(of(F.broadcast(parts[0].unionByName(parts[1]))), _ids, "label int, fold int, lang string, ids binary").toPandas()
    rows = rows.assign(key=[zlib.crc32(bytes(x)) for x in rows["ids"]]).sort_values(["label", "key"], kind="stable") if len(rows) else rows
    y = rows["label"].to_numpy()
    if len(set(y)) < 2:
        return ToxicityModel()
    m = fit([np.frombuffer(x, np.int32) for x in rows["ids"]], y)
    learn_languages(of(small_side(named, 16)), m)
    calibrate(of(small_side(named.where("fold = 0"), 16)), m)
    return m


def _score(shared):
    def run(batches):
        for batch in slices(batches, 1):
            scores = shared.value.scores(as_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])
    return run


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1; from 0.5 on toxic) of every row, from its whole text alone.

    Null and empty texts have no words and get the model's score of nothing.  Rows with a null id and
    repeated rows are scored like any other.  Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, _score(shared), "doc_id bigint, score double")


def _keep(shared, at):
    def run(batches):
        for batch in slices(batches, at):
            scores = np.array(shared.value.scores(as_bytes(batch.column(at))))
            yield batch.filter(pa.array(scores < 0.5, pa.bool_()))
    return run


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows that score below 0.5, with all their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_batches(docs, _keep(shared, docs.columns.index(text_col)), docs.schema)
