"""Exact deduplication by skew-safe combining.

Equal texts are found in three steps that all group by the full text, not only by its digest:
each task first combines its own copies (the partial aggregate), copies of a hot digest are then
merged under a salt, and the winners of the salts are combined at the end.  A group of copies that
holds a third of all rows so sends at most one row per task and salt.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut, map_batches
from .text import as_bytes, slices


def _normalise(with_text: bool):
    def run(batches):
        for batch in slices(batches, 1):
            texts = [t.lower() for t in as_bytes(batch.column(1))]
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            columns = [batch.column(0), digests]
            names = ["id", "sha"]
            if with_text:
                columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
                names.append("norm")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _read_back(keyed: DataFrame, classes: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows with the class of their digest; those of the hot digests, a bounded list, meet it by broadcast, so
    that no task gathers their rows."""
    hot = F.broadcast(hot.select("digest"))
    few = classes.join(hot, "digest", "left_semi")
    rest = keyed.join(hot, "digest", "left_anti").join(classes.join(hot, "digest", "left_anti"), "digest")
    return keyed.join(F.broadcast(few), "digest").unionByName(rest)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                max_hot: int = 4096, digest_bytes: int = 32) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; of equal texts the row with the largest
    id stays.  ``max_hot``: digests with more than 1/max_hot of all rows are salted, so at most
    ``max_hot`` digests are (the broadcast list is bounded by that, whatever the input).
    ``digest_bytes``: leading bytes of SHA-256 used to group; texts that share a digest but differ
    are told apart by their content, whatever its length.

    Null text counts as empty.  Rows with a null id are grouped, sort below all other ids, and are
    kept only when their whole group has none.  Rows that repeat an id with an equal text share one
    verdict.  Other columns are ignored.  No rows give no rows.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    digest = F.substring("sha", 1, digest_bytes).alias("digest")
    ids = cut(map_batches(rows, _normalise(False), "id bigint, sha binary"))
    keyed = ids.select("id", "sha", digest)
    hot = cut(keyed.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") * max_hot > ids.count()).select("digest", F.lit(True).alias("hot")))
    full = (map_batches(rows, _normalise(True), "id bigint, sha binary, norm string")
            .select("id", "norm", digest))
    salted = (full.join(F.broadcast(hot), "digest", "left")
              .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(salts)))))
    merged = salted.groupBy("digest", "salt", "norm").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    # A row without salt is already a whole class, named by its kept id; only the winners of
    # salts still have to meet, by digest and full text.
    whole = F.col("salt").isNull()
    classes = (merged.groupBy("digest", whole.alias("whole"), F.when(whole, F.col("keep")).alias("name"),
                              F.when(~whole, F.col("norm")).alias("hot_text"))
               .agg(F.max("keep").alias("keep_id"), F.sum("n").alias("group_size"))
               .select("digest", "keep_id", "group_size"))
    classes = cut(classes)
    clashes = cut(classes.groupBy("digest").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("digest"))
    out = _read_back(keyed, classes, hot).select("id", "sha", "keep_id", "group_size")
    if not clashes.isEmpty():
        plain = _read_back(keyed.join(clashes, "digest", "left_anti"), classes, hot)
        there = full.join(clashes, "digest", "left_semi")
        sizes = there.groupBy("digest", "norm").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        mixed = there.join(sizes, ["digest", "norm"])
        out = (plain.select("id", "sha", "keep_id", "group_size")
               .unionByName(mixed.select("id", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size")))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                      F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"))
