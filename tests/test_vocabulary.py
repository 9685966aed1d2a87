import random

import pytest
from pyspark.sql import functions as F

from irspark.contracts import BROADCAST_MAX_ROWS_CONF
from irspark.functions import text as T
from irspark.operators import index as ix
from irspark.operators import lexical as lx


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set(BROADCAST_MAX_ROWS_CONF, "0")
    yield
    spark.conf.unset(BROADCAST_MAX_ROWS_CONF)


def corpus(spark, seed=1, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(2500)]
    rows = [(f"d{i}", " ".join(["the"] * rng.randint(1, 3) + rng.choices(words, k=rng.randint(0, 40)))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, text string").repartition(4), rows


def rows_of(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()))


def test_frequent_terms_are_joined_apart_beyond_the_bound(spark, monkeypatch):
    docs, _ = corpus(spark)
    monkeypatch.setattr(ix, "HOT_TERMS", 50)                            # 'the' holds more than 1/50 of the postings
    queries = spark.createDataFrame([("a", "the w1 w2"), ("b", "w3 w3 nowhere")], "query_id string, text string")
    got = []
    for bound in (None, "0"):
        if bound is not None:
            spark.conf.set(BROADCAST_MAX_ROWS_CONF, bound)
        try:
            index = ix.build_index(docs, T.tok_whitespace, reuse=False)
            got.append([rows_of(lx.bm25_term_weights(index)), rows_of(lx.tfidf_retrieve(index, queries, 9, T.tok_whitespace))])
            if bound is not None:
                table = index.term_df.select("term", F.lit(1).alias("one"))
                plan = index.with_terms(table)._jdf.queryExecution().executedPlan().toString()
                assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and "CartesianProduct" not in plan
                assert rows_of(index.with_terms(table).drop("one")) == rows_of(index.postings.select("term", "doc_id", "tf", "dl"))
        finally:
            spark.conf.unset(BROADCAST_MAX_ROWS_CONF)
    assert got[0] == got[1] and len(got[0][0]) > 5000


def test_mapping_the_vocabulary_equals_mapping_the_tokens(spark):
    docs, rows = corpus(spark, 2, 80)
    index = ix.build_index(docs, T.tok_whitespace, reuse=False)
    mapping = spark.createDataFrame([(f"w{i}", f"w{i % 40}") for i in range(1500)] + [("gone", "x"), ("w3", "w3"), (None, "n")], "term string, mapped string")
    form = {f"w{i}": f"w{i % 40}" for i in range(1500)}
    want = {}
    for d, text in rows:
        for w in text.split():
            key = (d, form.get(w, w))
            want[key] = want.get(key, 0) + 1
    mapped = index.mapped(mapping)
    assert {(r["doc_id"], r["term"]): r["tf"] for r in mapped.postings.collect()} == want
    plan = mapped.postings._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(doc_id" not in plan               # buckets hold whole documents
    stats = mapped.stats.first()
    assert stats["n_postings"] == len(want) and stats["n_docs"] == 80
    assert {r["term"]: r["df"] for r in mapped.term_df.collect()}["the"] == 80


MAPPING = [("walking", "walk"), ("talked", "talk"), ("é", "e"), (None, "no"), ("same", "b"), ("same", "a"), ("null", None)]
TOKENS = [("d1", ["walking", "talked", "cat", "walking"], 1), ("d2", [], 2), ("d3", None, 3), ("d4", ["é", None, "null", "same"], 4), (None, ["talked"], 5)]


def normalised(spark):
    df = spark.createDataFrame(TOKENS, "doc_id string, tokens array<string>, _l int").repartition(3)
    out = T.normalize_terms(df, spark.createDataFrame(MAPPING, "term string, mapped string"))
    assert out.columns == ["doc_id", "tokens", "_l"]
    return out


WANT = {"d1": ["walk", "talk", "cat", "walk"], "d2": [], "d3": [], "d4": ["e", None, "null", "a"]}


def test_normalize_terms_moves_no_row(spark):
    out = normalised(spark)
    assert {r["doc_id"]: r["tokens"] for r in out.collect()} == {**WANT, None: ["talk"]}
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_normalize_terms_by_join_beyond_the_bound(spark, no_broadcast):
    df = spark.createDataFrame([(d, t) for d, t, _ in TOKENS if d], "doc_id string, tokens array<string>")
    out = T.normalize_terms(df, spark.createDataFrame(MAPPING, "term string, mapped string"))
    assert {r["doc_id"]: r["tokens"] for r in out.collect()} == WANT


LANGS = [("1", "en", ["the", "la", "cat", "the", "dog"]), ("2", "fr", ["la", "the", "chat", None]), ("3", None, ["the", "la"]),
         ("4", "xx", ["the"]), ("5", "en", []), ("6", "fr", None)]
STOP = [("the", "en"), ("a", "en"), ("la", "fr"), (None, "fr"), ("cat", None)]


@pytest.mark.parametrize("inline", [1024, 0])
def test_stopwords_of_each_language(spark, monkeypatch, inline):
    monkeypatch.setattr(T, "INLINE_WORDS", inline)
    df = spark.createDataFrame(LANGS, "doc_id string, lang string, tokens array<string>")
    words = spark.createDataFrame(STOP, "word string, lang string")
    by = {r["doc_id"]: r["tokens"] for r in T.remove_stopword_table(df, words, lang_col="lang").collect()}
    assert by == {"1": ["la", "cat", "dog"], "2": ["the", "chat", None], "3": ["the", "la"], "4": ["the"], "5": [], "6": None}
    every = {r["doc_id"]: r["tokens"] for r in T.remove_stopword_table(df, words.select("word")).collect()}
    assert every == {"1": ["dog"], "2": ["chat", None], "3": [], "4": [], "5": [], "6": None}


def test_stopwords_of_the_row_itself(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["a"]), (["a", "b"], None), (["a"], [])], "t array<string>, w array<string>")
    got = [r["x"] for r in df.select(T.remove_stopwords("t", F.col("w")).alias("x")).collect()]
    assert got == [["b"], ["a", "b"], ["a"]]
