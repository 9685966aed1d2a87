"""Score a stream of queries against a materialised index with ``foreachBatch``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.index import Index
from ..operators.lexical import bm25_retrieve


def score_query_stream(queries_stream: DataFrame, index: Index, out_path: str, checkpoint_path: str,
                       k: int = 10, tokenizer=None, trigger: dict | None = None):
    """Start a streaming query: each micro-batch of (query_id, text) rows is scored with the
    batch BM25 operator and written to ``out_path/batch_id=<id>`` (overwrite: a replayed batch
    after a failure replaces its own output).  Returns the StreamingQuery."""

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run = bm25_retrieve(index, batch, k, tokenizer=tokenizer).withColumn("batch_id", F.lit(batch_id))
        run.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = queries_stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint_path)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
