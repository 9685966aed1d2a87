"""Shared DataFrame helpers of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BROADCAST_BYTES = 32 << 20           # largest side that is broadcast, in bytes


BATCH_BYTES = 8 << 20                # most bytes of one Arrow batch, unless the session says otherwise


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, as texts may be very long."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def cut(df: DataFrame) -> DataFrame:
    """Write the frame once to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a written side for broadcast if its rows fit the limit; else leave it to a shuffle join."""
    return F.broadcast(df) if df.limit(limit // row_bytes + 1).count() <= limit // row_bytes else df


def remainder(id_col: str | Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; a null id counts as the empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % modulus


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The documents whose id is not among ``ids`` (one bigint column of that name)."""
    ids = cut(ids.select(F.col(id_col).alias("_gone")).distinct())
    return docs.join(small_side(ids, 16), F.col(id_col) == F.col("_gone"), "left_anti")


def bounded_sample(df: DataFrame, id_col: str, bound: int) -> DataFrame:
    """About ``bound`` rows, the same ones each time: those with the lowest hashes of their id."""
    n = df.count()
    if n <= bound:
        return df
    scale = 1 << 30
    return df.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(scale)) < int(scale * (bound / n)))
