"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A short test item inside a long document has a tiny Jaccard similarity with it, so sketches of one
fixed size miss it.  Here documents are partitioned by their size (powers of two of the number of
shingles), and each partition has a one-permutation MinHash with a number of bins in proportion to
that size: bin minima are kept per bin, so a shared shingle stays visible with a probability that
does not fall as documents grow.  Items are partitioned by how many shared shingles a match needs
(again powers of two); the fewer, the more bins.  The number of bins is the smallest power of two for
which a true match goes unseen with a probability of at most ``miss``.  An item of few shingles
takes every shingle as its own bin, which cannot miss.

A document and an item that agree in a bin's minimum are candidates; the share of the item's
shingles in the whole document is then counted on the shingles themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import BROADCAST_BYTES, cut, map_batches
from .text import as_bytes, bounds, groups, hashed_words, shingle_hashes, shingle_set, slices

PAIRS = "doc_id bigint, item_id bigint, item_shingles int, shared_shingles int"


def needed(n: int, threshold: float) -> int:
    """Shared shingles that an item of n distinct shingles needs."""
    return max(1, math.ceil(threshold * n - 1e-9))


def bins_log2(size_class: int, need_class: int, miss: float) -> int:
    """log2 of the bins for documents of up to 2**size_class shingles and items needing at least
    2**need_class shared ones; 64 stands for no thinning at all."""
    c = 1 << need_class
    for extra in range(-4, 6):
        load = 2.0 ** -extra                                     # shingles per bin
        visible = (1 - math.exp(-load)) / load
        if (1 - visible) ** c <= miss:
            return max(0, size_class + extra)
    return 64


def sketch(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The least hash of every bin that has one; a bin is the leading ``bins`` bits of a hash."""
    h = np.unique(hashes)
    if bins >= 64 or not len(h):
        return h
    if bins == 0:
        return h[:1]
    at = h >> np.uint64(64 - bins)
    return h[np.r_[True, at[1:] != at[:-1]]]


def size_class(n: int) -> int:
    return max(0, n - 1).bit_length()


class Items:
    """The test items as sorted sketch keys, one table for each pair of size classes in use."""

    def __init__(self, rows: list[tuple[int, bytes]], k: int, threshold: float, miss: float):
        self.k, self.miss = k, miss
        self.ids = [i for i, _ in rows]
        self.sets = [shingle_set(t, k) for _, t in rows]
        self.need = [needed(len(s), threshold) if s else 0 for s in self.sets]
        where, h = shingle_hashes(*hashed_words([t for _, t in rows]), k)
        at = bounds(where, len(rows))
        self.hashes = [h[at[i]:at[i + 1]] for i in range(len(rows))]
        self.by_class: dict[int, list[int]] = {}
        for i, c in enumerate(self.need):
            if c:
                self.by_class.setdefault(c.bit_length() - 1, []).append(i)
        self.tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def table(self, need_class: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
        if (need_class, bins) not in self.tables:
            keys = [sketch(self.hashes[i], bins) for i in self.by_class[need_class]]
            who = np.repeat(self.by_class[need_class], [len(x) for x in keys])
            keys = np.concatenate(keys)
            order = np.argsort(keys, kind="stable")
            self.tables[need_class, bins] = keys[order], who[order]
        return self.tables[need_class, bins]

    def candidates(self, hashes: np.ndarray) -> set[int]:
        """Items that agree with a document in the minimum of some bin."""
        found: set[int] = set()
        for c in self.by_class:
            bins = bins_log2(size_class(len(hashes)), c, self.miss)
            keys, who = self.table(c, bins)
            mine = sketch(hashes, bins)
            lo = np.searchsorted(keys, mine, "left")
            hit = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == mine)
            if len(hit):
                hi = np.searchsorted(keys, mine[hit], "right")
                for a, b in zip(lo[hit].tolist(), hi.tolist()):
                    found.update(who[a:b].tolist())
        return found

    def verified(self, text: bytes, candidates) -> list[tuple[int, int, int]]:
        """(item, its shingles, shared shingles) of the candidates that the whole text contains."""
        if not candidates:
            return []
        own = shingle_set(text, self.k)
        shared = ((i, len(self.sets[i] & own)) for i in sorted(candidates))
        return [(i, len(self.sets[i]), n) for i, n in shared if n >= self.need[i]]


def _search(rows, k, threshold, miss):
    def run(batches):
        items = Items(rows, k, threshold, miss)
        for batch in slices(batches, 1):
            texts, ids = as_bytes(batch.column(1)), batch.column(0).to_pylist()
            out = []
            for first, last in groups(texts):
                where, h = shingle_hashes(*hashed_words(texts[first:last]), k)
                at = bounds(where, last - first)
                for i in range(last - first):
                    own = h[at[i]:at[i + 1]]
                    if len(own):
                        text = texts[first + i]
                        out += [(ids[first + i], items.ids[j], n, s)
                                for j, n, s in items.verified(text, items.candidates(own))]
            yield _pairs(out)
    return run


def _pairs(out):
    names = ["doc_id", "item_id", "item_shingles", "shared_shingles"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    columns = [pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def _document_keys(need_classes, k, miss):
    def run(batches):
        for batch in slices(batches, 1):
            texts, ids = as_bytes(batch.column(1)), batch.column(0).to_pylist()
            for first, last in groups(texts):
                where, h = shingle_hashes(*hashed_words(texts[first:last]), k)
                at = bounds(where, last - first)
                for i in range(last - first):
                    own = h[at[i]:at[i + 1]]
                    for c in need_classes if len(own) else ():
                        bins = bins_log2(size_class(len(own)), c, miss)
                        mine = sketch(own, bins).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(mine), c * 128 + bins, np.int32)), pa.array(mine),
                             pa.array([ids[first + i]] * len(mine), pa.int64())], ["part", "key", "doc_id"])
    return run


def _item_keys(bins_of, k, threshold):
    def run(batches):
        for batch in slices(batches, 1):
            texts, ids = as_bytes(batch.column(1)), batch.column(0).to_pylist()
            where, h = shingle_hashes(*hashed_words(texts), k)
            at = bounds(where, len(texts))
            for i, t in enumerate(texts):
                own = h[at[i]:at[i + 1]]
                if not len(own):
                    continue
                c = needed(len(shingle_set(t, k)), threshold).bit_length() - 1
                for bins in bins_of[c]:
                    keys = sketch(own, bins).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), c * 128 + bins, np.int32)), pa.array(keys),
                         pa.array([ids[i]] * len(keys), pa.int64())], ["part", "key", "item_id"])
    return run


def _verify(k, threshold):
    def run(batches):
        for batch in batches:
            docs, items = as_bytes(batch.column(2)), as_bytes(batch.column(3))
            out = []
            for d, i, text, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), docs, items):
                want = shingle_set(item, k)
                n = len(want & shingle_set(text, k))
                if want and n >= needed(len(want), threshold):
                    out.append((d, i, len(want), n))
            yield _pairs(out)
    return run


def _classes(k, threshold):
    """Need classes that the items of a batch have."""
    def run(batches):
        for batch in batches:
            sizes = {len(shingle_set(t, k)) for t in as_bytes(batch.column(1))} - {0}
            yield pa.RecordBatch.from_arrays(
                [pa.array([needed(n, threshold).bit_length() - 1 for n in sizes], pa.int32())], ["c"])
    return run


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", shingle: int = 5,
                 threshold: float = 0.8, miss: float = 1e-9, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every (doc_id, item_id) whose item has at least ``threshold`` of its distinct ``shingle``-word
    shingles in the document, with item_shingles, shared_shingles and containment.

    ``miss``: bound on the chance that a pair at the threshold is no candidate.  Items whose texts
    fit ``broadcast_bytes`` go to every task as sketch tables, and the documents are not shuffled;
    a larger set of items is joined on its sketch keys, with the same result.

    A text of fewer words than ``shingle`` is one shingle; a text without words (null, empty) has
    none and never matches.  Rows that repeat an id are searched on their own and give their pairs
    once.  Null ids are kept as null.  Other columns are ignored.  No rows give no rows.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_id_col).cast("bigint").alias("item_id"),
                         F.col(item_text_col).cast("string").alias("item"))
    size = items.agg(F.sum(F.coalesce(F.octet_length("item"), F.lit(0)) + 16)).first()[0] or 0
    if size <= broadcast_bytes:
        rows = [(r[0], (r[1] or "").encode()) for r in items.distinct().collect()]
        found = map_batches(docs, _search(rows, shingle, threshold, miss), PAIRS).distinct()
    else:
        classes = sorted(r[0] for r in map_batches(items, _classes(shingle, threshold), "c int").distinct().collect())
        bins_of = {c: sorted({bins_log2(s, c, miss) for s in range(64)}) for c in classes}
        doc_keys = map_batches(docs, _document_keys(classes, shingle, miss), "part int, key bigint, doc_id bigint")
        item_keys = map_batches(items, _item_keys(bins_of, shingle, threshold), "part int, key bigint, item_id bigint")
        pairs = cut(doc_keys.join(item_keys, ["part", "key"]).select("doc_id", "item_id").distinct())
        texts = (pairs.join(docs, pairs["doc_id"].eqNullSafe(docs["doc_id"]))
                 .join(items, pairs["item_id"].eqNullSafe(items["item_id"]))
                 .select(pairs["doc_id"], pairs["item_id"], "text", "item"))
        found = map_batches(texts, _verify(shingle, threshold), PAIRS).distinct()
    return found.withColumn("containment", F.col("shared_shingles") / F.col("item_shingles"))
