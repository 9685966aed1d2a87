"""Named vector tables: kept between jobs, merged batch by batch.

A table is a folder of buckets by a hash of the point id.  An upsert reads and rewrites the buckets that
its batch touches; all others stay as they are.  A manifest says which generation of each bucket holds,
and is written last, so that a job that fails leaves the table as it was.  One writer at a time;
readers keep the generation they opened.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..contracts import bounded_broadcast, require_columns
from ..session import ensure_checkpoint_dir
from .vector import point_rows

MANIFEST = "seq bigint, bucket int, generation string, rows bigint"


class VectorTable:
    """Points (point_id, item_id, text, extra columns, embedding) under a name.

    ``root`` is a folder that the driver and all executors share (default: one in ``spark.checkpoint.dir``).
    ``buckets`` counts when the table is first written, about one per 256 MB of vectors to come.
    """

    def __init__(self, spark: SparkSession, name: str, root: str | None = None, buckets: int = 64):
        self.spark, self.name, self.buckets = spark, name, buckets
        self.path = os.path.join(root or os.path.join(ensure_checkpoint_dir(spark), "irspark-vectors"), name)

    def _manifest(self) -> list:
        """The entries of the last complete upsert: at most one a bucket."""
        try:
            entries = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException:
            return []
        last = entries.agg(F.max("seq")).first()[0]
        return [] if last is None else entries.where(F.col("seq") == last).collect()

    def _facts(self) -> tuple[StructType, int, int] | None:
        try:
            r = self.spark.read.schema("layout string, buckets int, dim int").parquet(f"{self.path}/facts").first()
        except AnalysisException:
            return None
        return StructType.fromJson(json.loads(r["layout"])), r["buckets"], r["dim"]

    def exists(self) -> bool:
        return self._facts() is not None and bool(self._manifest())

    def files(self) -> dict[int, str]:
        """The folder of each bucket that has rows."""
        return {r["bucket"]: f"{self.path}/data/{r['generation']}/bucket={r['bucket']}" for r in self._manifest() if r["rows"]}

    def read(self) -> DataFrame:
        """The points as of the last upsert, one row each."""
        facts = self._facts()
        folders = self.files()
        if facts is None:
            raise ValueError(f"vector table '{self.name}' does not exist")
        if not folders:
            return self.spark.createDataFrame([], facts[0])
        return self.spark.read.schema(facts[0]).parquet(*[folders[b] for b in sorted(folders)])

    def upsert(self, new: DataFrame, id_col: str = "item_id", text_col: str = "text", vec_col: str = "embedding",
               extra_cols=None, seq_col: str | None = None) -> "VectorTable":
        """Insert or replace by point id; of rows with one id the last by ``seq_col`` (input order) wins.

        The first batch sets the columns and the length of the vectors; later ones may leave columns out
        (null), but not add any.  Vectors that are null or of another length raise, and nothing is written."""
        batch = point_rows(new, id_col, text_col, vec_col, extra_cols, seq_col)
        facts = self._facts()
        layout, n, dim = facts or (batch.schema, self.buckets, None)
        unknown = [c for c in batch.columns if c not in layout.names]
        if unknown:
            raise ValueError(f"vector table '{self.name}' has no column " + ", ".join(unknown))
        batch = batch.select(*[(F.col(f.name).cast(f.dataType) if f.name in batch.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                               for f in layout.fields], F.pmod(F.xxhash64("point_id"), F.lit(n)).cast("int").alias("bucket"))
        batch = batch.checkpoint(eager=True)
        sizes = batch.agg(F.min(F.coalesce(F.size("embedding"), F.lit(-1))).alias("low"), F.max(F.size("embedding")).alias("high")).first()
        if sizes["low"] is None:
            return self
        if sizes["low"] != sizes["high"] or sizes["low"] < 0 or dim not in (None, sizes["low"]):
            raise ValueError(f"vector table '{self.name}' needs vectors of one length" + (f", {dim}" if dim else ""))
        before = {r["bucket"]: r for r in self._manifest()}
        touched = sorted(r["bucket"] for r in batch.select("bucket").distinct().collect())       # at most ``buckets``
        kept = [self.files()[b] for b in touched if b in before and before[b]["rows"]]
        rows = batch
        if kept:
            old = self.spark.read.schema(layout).parquet(*kept)
            old = old.join(bounded_broadcast(batch.select("point_id")), "point_id", "left_anti")
            rows = batch.unionByName(old.withColumn("bucket", F.pmod(F.xxhash64("point_id"), F.lit(n)).cast("int")))
        if facts is None:
            self.spark.createDataFrame([(layout.json(), n, sizes["low"])], "layout string, buckets int, dim int").coalesce(1) \
                .write.mode("overwrite").parquet(f"{self.path}/facts")
        generation = uuid.uuid4().hex
        target = f"{self.path}/data/{generation}"
        rows.repartition(len(touched), "bucket").write.partitionBy("bucket").parquet(target)
        written = self.spark.read.schema("bucket int").parquet(target).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        seq = max((r["seq"] for r in before.values()), default=0) + 1
        now = {b: (seq, b, r["generation"], r["rows"]) for b, r in before.items()}
        now.update({r["bucket"]: (seq, r["bucket"], generation, r["n"]) for r in written})
        (self.spark.createDataFrame(sorted(now.values()), MANIFEST).coalesce(1)
         .write.mode("append").parquet(f"{self.path}/manifest"))
        return self


def open_vectors(spark: SparkSession, name: str, docs: DataFrame | None = None,
                 embed: Callable[[DataFrame], DataFrame] | None = None, root: str | None = None, **columns) -> VectorTable:
    """The named table.  An existing one is used as it is and nothing is embedded; else ``embed(docs)`` is
    written under that name.  Without ``docs`` a missing table raises."""
    table = VectorTable(spark, name, root)
    if table.exists():
        return table
    if docs is None or embed is None:
        raise ValueError(f"vector table '{name}' does not exist")
    if docs.isEmpty():
        raise ValueError("docs must contain at least one document")
    found = embed(docs)
    require_columns(found, {columns.get("id_col", "item_id"), columns.get("vec_col", "embedding")}, "embedded docs")
    return table.upsert(found, **columns)
