import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from irspark.functions.vectors import point_id
from irspark.operators import fuse as FU
from irspark.operators import vector as V


def test_minmax_equal_scores_and_alpha_bounds(spark):
    run = spark.createDataFrame([("q", "a", 2.0), ("q", "b", 2.0), ("r", "c", 1.0), ("r", "d", 3.0)],
                                "query_id string, doc_id string, score double")
    got = {(r["query_id"], r["doc_id"]): r["norm"] for r in FU.minmax_by_query(run).collect()}
    assert got == {("q", "a"): 0.0, ("q", "b"): 0.0, ("r", "c"): 0.0, ("r", "d"): 1.0}
    with pytest.raises(ValueError):
        FU.mix_runs(run, run, 1.5)


def test_alpha_one_keeps_bm25_order(spark):
    bm = spark.createDataFrame([("q", "a", 5.0), ("q", "b", 3.0), ("q", "c", 1.0)], "query_id string, doc_id string, score double")
    vec = spark.createDataFrame([("q", "c", 0.9), ("q", "d", 0.8)], "query_id string, doc_id string, score double")
    m = {r["doc_id"]: r["score"] for r in FU.mix_runs(bm, vec, 1.0).collect()}
    assert m["a"] > m["b"] > m["c"] and m["d"] == 0.0


def test_uuid5_point_ids(spark):
    ids = ["007", "7", "doc-1", "Ünïcode"]
    df = spark.createDataFrame([(i,) for i in ids], "item_id string")
    got = [r["p"] for r in df.select(point_id("item_id").alias("p")).collect()]
    assert got[0] == got[1] == "7"
    assert got[2] == str(uuid.uuid5(uuid.NAMESPACE_URL, "doc-1"))
    assert got[3] == str(uuid.uuid5(uuid.NAMESPACE_URL, "Ünïcode"))


def test_upsert_new_wins(spark):
    old = spark.createDataFrame([("1", "x", [1.0], 1), ("2", "y", [2.0], 2)], "item_id string, text string, embedding array<double>, label int")
    new = spark.createDataFrame([("01", "z", [3.0], 9)], "item_id string, text string, embedding array<double>, label int")
    out = {r["point_id"]: (r["text"], r["label"]) for r in V.upsert_vectors(old, new).collect()}
    assert out == {"1": ("z", 9), "2": ("y", 2)}


def test_vector_topk_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    D = rng.normal(size=(300, 8))
    Q = rng.normal(size=(5, 8))
    docs = spark.createDataFrame([(str(i), D[i].tolist()) for i in range(300)], "item_id string, embedding array<double>").repartition(4)
    qs = spark.createDataFrame([(f"q{i}", Q[i].tolist()) for i in range(5)], "query_id string, embedding array<double>")
    run = V.vector_retrieve(qs, docs, 7).collect()
    Dn = D / np.linalg.norm(D, axis=1, keepdims=True)
    for i in range(5):
        q = Q[i] / np.linalg.norm(Q[i])
        s = Dn @ q
        exp = [str(j) for j in np.argsort(-s)[:7]]
        got = [r["doc_id"] for r in sorted((r for r in run if r["query_id"] == f"q{i}"), key=lambda r: -r["score"])]
        assert got == exp


def test_vector_ties_go_by_doc_id(spark):
    rows = [(f"{i:03d}", [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(80)]
    d = spark.createDataFrame(rows, "item_id string, embedding array<double>").repartition(5)
    q = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    got = sorted(r["doc_id"] for r in V.vector_retrieve(q, d, 5).collect())
    assert got == ["001", "003", "005", "007", "009"]


def test_vector_topk_over_several_query_blocks_and_slices(spark, monkeypatch):
    rng = np.random.default_rng(3)
    D, Q = rng.normal(size=(200, 4)).round(1), rng.normal(size=(23, 4)).round(1)
    docs = spark.createDataFrame([(f"{i:03d}", D[i].tolist()) for i in range(200)], "item_id string, embedding array<double>").repartition(3)
    qs = spark.createDataFrame([(f"q{i}", Q[i].tolist()) for i in range(23)], "query_id string, embedding array<double>")
    whole = sorted(map(tuple, V.vector_retrieve(qs, docs, 5).collect()))
    monkeypatch.setattr(V, "QUERY_BLOCK", 6)
    assert sorted(map(tuple, V.vector_retrieve(qs, docs, 5).collect())) == whole and len(whole) == 23 * 5


def test_vector_blocks_are_paired_by_spark_beyond_the_broadcast_bound(spark, monkeypatch):
    from irspark.contracts import BROADCAST_MAX_BYTES_CONF

    rng = np.random.default_rng(4)
    D, Q = rng.normal(size=(150, 4)).round(1), rng.normal(size=(40, 4)).round(1)
    D[3] = Q[5] = 0.0
    docs = spark.createDataFrame([(f"{i:03d}", D[i].tolist()) for i in range(150)], "item_id string, embedding array<double>").repartition(3)
    qs = spark.createDataFrame([(f"q{i}", Q[i].tolist()) for i in range(40)], "query_id string, embedding array<double>")
    whole = sorted(map(tuple, V.vector_retrieve(qs, docs, 5).collect()))
    frame = type(docs)
    sent, collect = [], frame.collect
    monkeypatch.setattr(V, "DOC_BLOCK", 16)
    monkeypatch.setattr(frame, "collect", lambda self: sent.append(collect(self)) or sent[-1])
    spark.conf.set(BROADCAST_MAX_BYTES_CONF, "700")
    try:
        run = V.vector_retrieve(qs, docs, 5, query_block=7)
    finally:
        spark.conf.unset(BROADCAST_MAX_BYTES_CONF)
    monkeypatch.setattr(frame, "collect", collect)
    assert sorted(map(tuple, run.collect())) == whole and len(whole) == 200
    assert sum(map(len, sent)) < 10                                     # counts, never queries or documents
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) != str(V.BATCH_BYTES)
    with pytest.raises(Exception, match="components"):
        V.vector_retrieve(qs, docs.unionByName(docs.limit(1).withColumn("embedding", F.expr("array(1.0D)"))), 5)


def test_containment_pairs_equal_brute_force(spark):
    import random

    from irspark.sources.fixtures import containment_pairs

    rnd = random.Random(5)
    words = ["ab", "Cd", "ef", "gh", "ij", "kl", "é", "ab-cd"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12))) for _ in range(80)] + [None, "", "x" * 50]
    pats = [t[rnd.randint(0, 3):][:rnd.randint(1, 20)] for t in texts[:40] if t] + ["b C", "-", " ", "", None, "zz zz zz zz", "xx"]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, text string")
    qs = spark.createDataFrame([(str(i), t) for i, t in enumerate(pats)], "query_id string, text string")
    got = sorted(map(tuple, containment_pairs(docs, qs).collect()))
    assert got == sorted((str(i), str(j)) for i, p in enumerate(pats) if p for j, t in enumerate(texts) if t and p in t)
