import pytest
from pyspark.sql import functions as F

from irspark import pipelines as PL
from irspark.contracts import Measure, bounded_broadcast, measures_at
from irspark.operators import lexical as lx

WORDS = "red green blue cyan pink gold gray teal navy lime rust sand".split()


def collection(spark, n=60):
    texts = [(f"d{i:02d}", " ".join([WORDS[i % 12]] * (1 + i // 12 % 3) + [WORDS[(i * 5 + 1) % 12], f"t{i}"])) for i in range(n)]
    docs = spark.createDataFrame(texts, "doc_id string, text string")
    queries = spark.createDataFrame([(f"q{j}", WORDS[j], "train" if j < 8 else "test") for j in range(12)],
                                    "query_id string, text string, split string")
    qrels = spark.createDataFrame([(f"q{j}", f"d{i:02d}", 1) for j in range(12) for i in range(n) if i % 12 == j and i // 12 % 3 == 2],
                                  "query_id string, doc_id string, relevance int")
    return docs, queries, qrels


def test_measures_take_every_depth_once():
    got = measures_at(["P", "AP", "P@5", "nDCG@10", "MAP"], (10, 5, 0, 5))
    assert got == [Measure("P", 5), Measure("P", 10), Measure("AP", None), Measure("nDCG", 10)]


def test_broadcast_is_bounded_in_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "i int, t string")
    hinted = lambda d: "hint" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(bounded_broadcast(df))
    spark.conf.set("irspark.broadcast.maxBytes", "20000")
    try:
        assert not hinted(bounded_broadcast(df))
    finally:
        spark.conf.unset("irspark.broadcast.maxBytes")


def test_lexical_experiment_equals_its_parts(spark):
    docs, queries, qrels = collection(spark)
    done = PL.lexical_experiment(docs, queries, qrels, ks=(1, 5), metrics=["P", "AP"])
    assert done.depth == 5 and set(done.metrics.columns) == {"method", "P@1", "P@5", "AP"}
    assert done.per_query.count() == 2 * qrels.select("query_id").distinct().count()
    own = lx.bm25_retrieve(docs, queries, 5, tokenizer=lambda c: F.split(c, " "))
    assert sorted(map(tuple, done.runs.where("method = 'bm25'").drop("method").collect())) == sorted(map(tuple, own.collect()))


def test_empty_corpus_raises(spark):
    docs, queries, qrels = collection(spark)
    with pytest.raises(ValueError):
        PL.lexical_experiment(docs.limit(0), queries, qrels)
    with pytest.raises(ValueError):
        lx.bm25_retrieve(docs.limit(0), queries, 3)


def test_hybrid_experiment_tunes_on_train_only(spark):
    docs, queries, qrels = collection(spark)
    vec = lambda i: [1.0 if i % 12 == a else 0.1 for a in range(12)]
    dv = spark.createDataFrame([(f"d{i:02d}", vec(i)) for i in range(60)], "item_id string, embedding array<double>")
    qv = spark.createDataFrame([(f"q{j}", vec(j)) for j in range(12)], "query_id string, embedding array<double>")
    hide = qrels.withColumn("relevance", F.when(F.col("query_id").isin("q8", "q11"), 0).otherwise(F.col("relevance")))
    a = PL.hybrid_experiment(docs, queries, qrels, dv, qv, k=10)
    b = PL.hybrid_experiment(docs, queries, hide, dv, qv, k=10)
    assert a.details["alpha"] == b.details["alpha"] and a.details["alphas"].count() == 21
    names = {(r["split"], r["run_name"]) for r in a.metrics.collect()}
    assert names == {(s, r) for s in ("train", "test") for r in ("bm25", "vector", "mixed")}
    plain = PL.hybrid_experiment(docs, queries, qrels, dv, qv, k=10, alpha=None, scorer=F.length("doc_text"), rerank_k=5)
    assert {r["run_name"] for r in plain.metrics.collect()} == {"bm25", "vector", "reranked"}


def test_ltr_experiment_learns_and_keeps_queries_apart(spark):
    docs, queries, qrels = collection(spark)
    done = PL.ltr_experiment(docs, queries, qrels, depth=15)
    got = {r["method"]: r["nDCG@20"] for r in done.metrics.collect()}
    assert set(got) == {"bm25", "hash", "linear", "pairwise"}
    # longer repeats are relevant: the features tell them apart, a hash does not
    assert min(got["linear"], got["pairwise"]) > got["hash"]
    held = {r["query_id"] for r in done.details["split"].where("split = 'eval'").collect()}
    assert {r["query_id"] for r in done.runs.select("query_id").distinct().collect()} <= held


def test_tune_bm25_picks_the_first_best(spark):
    docs, queries, qrels = collection(spark)
    grid = spark.createDataFrame([(k1, b) for k1 in (0.9, 1.2) for b in (0.0, 0.75)], "k1 double, b double")
    k1, b, table = lx.tune_bm25(docs, queries, qrels, grid, "nDCG@10", 10)
    rows = sorted(table.collect(), key=lambda r: (-r["nDCG@10"], r["k1"], r["b"]))
    assert len(rows) == 4 and (k1, b) == (rows[0]["k1"], rows[0]["b"])


def test_ltr_experiment_joins_the_candidates_once(spark, monkeypatch):
    """Dense and sparse features read the written candidates; retrieval and document texts are not joined again."""
    docs, queries, qrels = collection(spark)

    class Seen(Exception):
        pass

    def stop(pairs, *_):
        raise Seen(pairs._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(PL, "bm25_pair_features", stop)
    with pytest.raises(Seen) as seen:
        PL.ltr_experiment(docs, queries, qrels, depth=15, methods=("pairwise_sparse",))
    assert "Join" not in str(seen.value)
