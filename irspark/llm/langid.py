"""Language identification by mixture inference.

Character trigrams of each language are counted on labelled rows.  Each document is then taken as a
mixture: expectation-maximisation estimates the share of every language from the likelihoods of the
document's trigrams.  The set of languages is chosen by penalised likelihood: starting from all, the
language with the least share is dropped as long as that lowers the log likelihood by less than the
penalty, which grows with the logarithm of the document's length.  All documents of a block are
estimated at once, as matrix products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_batches
from .text import as_bytes, blocks, slices

BITS = 12                            # trigrams are hashed into 2**BITS classes
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all other code points; made once per process."""
    if not _FOLD:
        codes = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if (ch := chr(c)).isalpha():
                low = ch.lower()
                codes[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(codes)
    return _FOLD[0]


def trigram_classes(text: bytes) -> np.ndarray:
    """Class of every trigram of the text: letters lower-cased, all else one space, with a space before
    and after.  Trigrams with no letter in the middle are left out; a text without letters has none."""
    codes = np.frombuffer(text.decode("utf-8").encode("utf-32-le"), np.uint32)
    c = np.zeros(len(codes) + 2, np.uint64)
    c[1:-1] = _fold()[codes]
    h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) + c[2:] * np.uint64(0x165667B19E3779F9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h[c[1:-1] > 0] >> np.uint64(64 - BITS)).astype(np.int64)


def class_counts(text: bytes) -> np.ndarray:
    """Trigrams of the whole text by class.  Long texts are counted in blocks cut at white space."""
    out = np.zeros(1 << BITS, np.int64)
    for piece in blocks(text):
        out += np.bincount(trigram_classes(piece), minlength=1 << BITS)
    return out


@dataclass
class LanguageModel:
    """Languages and the probability of each trigram class in each of them."""
    languages: list[str]
    probability: np.ndarray          # (classes, languages), float32

    def mixtures(self, counts: np.ndarray, rounds: int = 15, penalty: float = 3.0) -> np.ndarray:
        """Shares of the languages in each document (rows of trigram counts), 0 outside the chosen set.

        A document without trigrams has shares of 0."""
        p, n = self.probability, counts.sum(axis=1)
        counts = counts.astype(np.float32)
        docs, langs = len(counts), len(self.languages)
        chosen = np.ones((docs, langs), bool)
        share, like = self._estimate(counts, n, chosen, rounds)
        open_ = np.flatnonzero((n > 0) & (langs > 1))
        while len(open_):
            least = np.where(chosen[open_], share[open_], np.inf).argmin(axis=1)
            fewer = chosen[open_].copy()
            fewer[np.arange(len(open_)), least] = False
            new, new_like = self._estimate(counts[open_], n[open_], fewer, rounds, share[open_])
            better = like[open_] - new_like <= penalty * np.log(n[open_] + 1)
            went = open_[better]
            chosen[went], share[went], like[went] = fewer[better], new[better], new_like[better]
            open_ = went[chosen[went].sum(axis=1) > 1]
        share[n == 0] = 0
        return share

    def _estimate(self, counts, n, chosen, rounds, start=None):
        """EM from the given shares (even ones at first) within the chosen sets: shares, log likelihoods."""
        p = self.probability
        share = chosen / chosen.sum(axis=1, keepdims=True) if start is None else start * chosen + 1e-6 * chosen
        share = (share / share.sum(axis=1, keepdims=True)).astype(np.float32)
        several = np.flatnonzero(chosen.sum(axis=1) > 1)
        some, of = counts[several], share[several]
        for _ in range(rounds if len(several) else 0):
            ratio = some / (of @ p.T)
            of = of * (ratio @ p)
            of /= np.maximum(of.sum(axis=1, keepdims=True), 1e-30)
        share[several] = of
        like = np.einsum("ij,ij->i", counts, np.log(share @ p.T), dtype=np.float64)
        return share, like


def _partials(batches):
    """Trigram counts by language of all rows that the task has seen."""
    seen: dict[str, np.ndarray] = {}
    for batch in slices(batches, 1):
        for lang, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            seen[lang] = seen.get(lang, 0) + class_counts(text)
    for lang, counts in seen.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at])],
                                         ["lang", "class", "n"])


def train_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                    max_languages: int = 500) -> LanguageModel:
    """Trigram probabilities of each non-null value of ``lang_col``, from all labelled rows, whole texts.
    The model has as many rows as languages, so more than ``max_languages`` distinct values are refused
    with an error rather than cut."""
    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"),
                                                          F.col(text_col).cast("string").alias("text"))
    # refused before any counting, as a task keeps the counts of every language that it sees
    if len(known.select("lang").distinct().limit(max_languages + 1).collect()) > max_languages:
        raise ValueError(f"{lang_col} has more than {max_languages} values")
    counts = (map_batches(known, _partials, "lang string, class long, n long")
              .groupBy("lang", "class").agg(F.sum("n").alias("n")))
    rows = counts.toPandas()                                        # languages x classes at most
    names = sorted(rows["lang"].unique())
    table = np.full((1 << BITS, len(names)), 0.5)
    table[rows["class"], rows["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(int)] += rows["n"]
    return LanguageModel(names, (table / table.sum(axis=0)).astype(np.float32))


def _predict(shared):
    def run(batches):
        model = shared.value
        for batch in slices(batches, 1):
            texts = as_bytes(batch.column(1))
            for first in range(0, len(texts), 64):
                counts = np.stack([class_counts(t) for t in texts[first:first + 64]])
                share = model.mixtures(counts) if model.languages else np.zeros((len(counts), 0))
                lang, score, names, shares = [], [], [], []
                for row in share:
                    order = [k for k in np.argsort(-row, kind="stable") if row[k] > 0]
                    names.append([model.languages[k] for k in order])
                    shares.append([float(row[k]) for k in order])
                    lang.append(names[-1][0] if order else "und")
                    score.append(min(1.0, shares[-1][0]) if order else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, 64), pa.array(lang), pa.array(score, pa.float64()),
                     pa.array(names, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))],
                    ["doc_id", "lang_pred", "score", "languages", "shares"])
    return run


def language_mixtures(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, languages, shares of every row, from its whole text alone.

    ``lang_pred`` is the language of the largest share and ``score`` that share; of equal shares the
    first language by name wins.  Null texts, texts without letters, and all texts under a model
    without languages are ``und`` with a score of 0.  Null ids and repeated rows are scored like any
    other.  Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, _predict(shared),
                       "doc_id long, lang_pred string, score double, languages array<string>, shares array<double>")
