import os
import tempfile

from irspark.functions.text import tok_whitespace
from irspark.operators.index import build_index
from irspark.operators.lexical import bm25_retrieve
from irspark.streaming import score_query_stream


def test_query_stream_equals_batch(spark):
    docs = spark.createDataFrame([("d1", "a b c a"), ("d2", "a b"), ("d3", "c d e")], "doc_id string, text string")
    idx = build_index(docs, tok_whitespace)
    base = tempfile.mkdtemp(prefix="irspark-stream-")
    src = os.path.join(base, "in")
    q = spark.createDataFrame([("q1", "a c"), ("q2", "e")], "query_id string, text string")
    q.write.parquet(src)
    stream = spark.readStream.schema("query_id string, text string").parquet(src)
    sq = score_query_stream(stream, idx, os.path.join(base, "out"), os.path.join(base, "ckpt"), k=2,
                            tokenizer=tok_whitespace)
    sq.awaitTermination(120)
    got = sorted((r["query_id"], r["doc_id"], r["score"]) for r in spark.read.parquet(os.path.join(base, "out")).collect())
    exp = sorted((r["query_id"], r["doc_id"], r["score"]) for r in bm25_retrieve(idx, q, 2, tokenizer=tok_whitespace).collect())
    assert got == exp
