"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint is cut into 2r blocks for a distance of r bits.  Two fingerprints that differ in at
most r bits agree in at least r blocks, so they meet under one of the C(2r, r) choices of r blocks.
Equal fingerprints are taken as one first, so a group of copies costs one row.  Within the
fingerprints that share a choice, links to the lowest and to the highest are verified and joined
to components; only fingerprints of different components are then still compared, so that a
dense group is never expanded into all its pairs, and yet no link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut, map_batches
from .graph import connected_components
from .text import as_bytes, blocks, slices


MAX_HOT = 4096                       # fingerprints with over 1/MAX_HOT of all rows are hot


def _shingles(text: bytes, k: int):
    """Blocks of shingle byte strings of the whole text, repeats included, in order."""
    rest: list[bytes] = []
    seen = False
    for piece in blocks(text):
        words = rest + piece.lower().split()
        if len(words) >= k:
            seen = True
            line = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]).tolist()
            starts = [0, *ends]
            yield [line[starts[i]:ends[i + k - 1] - 1] for i in range(len(words) - k + 1)]
            words = words[len(words) - k + 1:] if k > 1 else []
        rest = words
    if not seen and rest:
        yield [b" ".join(rest)]


def simhash64(hashes: np.ndarray) -> int:
    """Bit i of the result is set when it is set in over half of the hashes; 0 for none."""
    return _fingerprint(*_bits(hashes))


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64), len(hashes)


def _fingerprint(ones: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(k: int, seed: int):
    def run(batches):
        from xxhash import xxh64_intdigest

        for batch in slices(batches, 1):
            out = []
            for text in as_bytes(batch.column(1)):
                ones, n = np.zeros(64, np.int64), 0
                for some in _shingles(text, k):
                    add, m = _bits(np.fromiter((xxh64_intdigest(s, seed) for s in some), np.uint64, len(some)))
                    ones, n = ones + add, n + m
                out.append(_fingerprint(ones, n) if n else 0)
            fp = pa.array(np.array(out, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["doc_id", "fp"])
    return run


def _choices(bits: int) -> list[int]:
    """Masks of every choice of ``bits`` of the 2 * bits blocks, as signed 64-bit values."""
    edges = [round(64 * i / (2 * bits)) for i in range(2 * bits + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [int(np.array(sum(c), np.uint64).view(np.int64)) for c in combinations(masks, bits)] if bits else [-1]


def _members(fps: DataFrame, bits: int, *more: str) -> DataFrame:
    masks = F.array(*[F.lit(m).cast("bigint") for m in _choices(bits)])
    cols = fps.select("fp", *more, F.posexplode(masks).alias("choice", "mask"))
    return cols.select("fp", *more, F.col("choice").cast("tinyint").alias("choice"),
                       F.col("fp").bitwiseAND(F.col("mask")).alias("block"))


def near_fingerprints(fps: DataFrame, bits: int = 3) -> DataFrame:
    """(node, root) of the distinct fingerprints that have a link of at most ``bits`` bits."""
    close = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits
    fps = cut(fps.select("fp").distinct())
    members = _members(fps, bits)
    hubs = (members.groupBy("choice", "block")
            .agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high"))
    near = (members.join(hubs, ["choice", "block"])
            .select("fp", F.explode(F.array("low", "high")).alias("hub"))
            .where((F.col("fp") != F.col("hub")) & close("fp", "hub"))
            .select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")))
    first = connected_components(near)
    # what is left: members of one block choice that lie in different components
    comp = fps.join(first, fps["fp"] == first["node"], "left").select("fp", F.coalesce("root", "fp").alias("comp"))
    members = _members(cut(comp), bits, "comp")
    mixed = cut(members.groupBy("choice", "block").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
                .where("x <> y").select("choice", "block"))
    left = members.join(mixed, ["choice", "block"], "left_semi")
    right = left.select("choice", "block", F.col("fp").alias("fp2"), F.col("comp").alias("comp2"))
    cross = (left.join(right, ["choice", "block"])
             .where((F.col("comp") < F.col("comp2")) & close("fp", "fp2"))
             .select(F.col("comp").alias("a"), F.col("comp2").alias("b")).distinct())
    over = connected_components(cross)
    up = over.toDF("first_root", "last_root")
    joined = comp.join(up, comp["comp"] == up["first_root"], "left")
    return joined.select(F.col("fp").alias("node"), F.coalesce("last_root", "comp").alias("root"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  bits: int = 3, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Words after lower-casing A-Z make ``shingle``-word shingles, repeats included; a text of fewer
    words is one shingle.  The fingerprint sums the bits of each shingle's XXH64 (``seed``).
    Fingerprints within ``bits`` bits link, and ``component_id`` is the smallest id reachable.

    Null text counts as empty; a text without words has fingerprint zero and links like any other.
    Rows with a null id take part but never name a component of others; a component of null ids
    only has a null component_id.  Repeated rows stay.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = cut(map_batches(rows, _fingerprints(shingle, seed), "doc_id bigint, fp bigint"))
    least = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    roots = cut(near_fingerprints(least, bits).join(least, F.col("node") == F.col("fp"))
                .select("fp", "root", "first"))
    named = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    of = cut(roots.join(named, "root").select("fp", "component_id"))
    # fingerprints of many rows, fewer than MAX_HOT, meet their component by broadcast, all others by shuffle
    hot = F.broadcast(least.where(F.col("n") * MAX_HOT > marked.count()).select("fp"))
    rest = marked.join(hot, "fp", "left_anti").join(of.join(hot, "fp", "left_anti"), "fp")
    return (marked.join(F.broadcast(of.join(hot, "fp", "left_semi")), "fp").unionByName(rest)
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
