import math

import pytest
from pyspark.sql import functions as F

from irspark.functions.text import tok_whitespace
from irspark.operators import lexical as lx
from irspark.operators.index import build_index

DOCS = [("d1", "a b c a"), ("d2", "a b"), ("d3", "c d e"), ("d4", "a a a a")]


def okapi(docs, query, k1=1.2, b=0.75, eps=0.25):
    """Plain-Python Okapi BM25 with the rank-bm25 conventions."""
    toks = {d: t.split() for d, t in docs}
    n = len(toks)
    avgdl = sum(len(t) for t in toks.values()) / n
    df = {}
    for t in toks.values():
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: (eps * mean if v < 0 else v) for w, v in idf.items()}
    out = {}
    for d, t in toks.items():
        s = 0.0
        for q in query.split():
            tf = t.count(q)
            s += idf.get(q, 0.0) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(t) / avgdl))
        out[d] = s
    return out


def test_bm25_matches_python_with_negative_idf_and_repeats(spark):
    docs = spark.createDataFrame(DOCS, "doc_id string, text string")
    q = spark.createDataFrame([("q1", "a a c"), ("q2", "e"), ("q3", "zzz")], "query_id string, text string")
    run = lx.bm25_retrieve(docs, q, 4, tokenizer=tok_whitespace).collect()
    got = {(r["query_id"], r["doc_id"]): r["score"] for r in run}
    for qid, text in [("q1", "a a c"), ("q2", "e")]:
        exp = okapi(DOCS, text)
        for d, s in exp.items():
            assert got[(qid, d)] == pytest.approx(round(s, 6), abs=1e-6)
    # zero fill: an unmatched query still gets min(k, N) documents, lowest ids first
    assert sorted(d for (qq, d) in got if qq == "q3") == ["d1", "d2", "d3", "d4"]
    assert all(got[("q3", d)] == 0.0 for d in ["d1", "d2", "d3", "d4"])


def test_k_zero_and_missing_columns(spark):
    docs = spark.createDataFrame(DOCS, "doc_id string, text string")
    q = spark.createDataFrame([("q1", "a")], "query_id string, text string")
    assert lx.bm25_retrieve(docs, q, 0).count() == 0
    with pytest.raises(ValueError, match="missing required columns: query_id"):
        lx.bm25_retrieve(docs, q.withColumnRenamed("query_id", "qid"), 3)


def test_tfidf_cosine_matches_sklearn_formula(spark):
    docs = spark.createDataFrame(DOCS, "doc_id string, text string")
    q = spark.createDataFrame([("q1", "a c")], "query_id string, text string")
    run = {r["doc_id"]: r["score"] for r in lx.tfidf_retrieve(docs, q, 4, tokenizer=tok_whitespace).collect()}
    toks = {d: t.split() for d, t in DOCS}
    n = len(toks)
    vocab = sorted({w for t in toks.values() for w in t})
    idf = {w: math.log((1 + n) / (1 + sum(w in t for t in toks.values()))) + 1 for w in vocab}

    def vec(t):
        v = {w: t.count(w) * idf[w] for w in vocab if w in t}
        nn = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / nn for w, x in v.items()}

    qv = vec(["a", "c"])
    for d, t in toks.items():
        dv = vec(t)
        assert run[d] == pytest.approx(round(sum(qv.get(w, 0) * x for w, x in dv.items()), 6), abs=1e-6)


def test_sparse_pair_rows_sum_to_lucene_bm25(spark):
    docs = spark.createDataFrame(DOCS, "doc_id string, text string")
    fitted = build_index(docs, tok_whitespace)
    pairs = spark.createDataFrame([("q1", "a c", "d1", "a b c a"), ("q1", "a c", "d3", "c d e")],
                                  "query_id string, query_text string, doc_id string, doc_text string")
    rows = lx.bm25_pair_features(pairs, fitted, tokenizer=tok_whitespace).collect()
    toks = {d: t.split() for d, t in DOCS}
    n, avgdl = 4, sum(len(t) for t in toks.values()) / 4
    for d in ("d1", "d3"):
        exp = 0.0
        for w in ("a", "c"):
            df = sum(w in t for t in toks.values())
            idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
            tf = toks[d].count(w)
            exp += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(toks[d]) / avgdl))
        got = sum(r["value"] for r in rows if r["doc_id"] == d)
        assert got == pytest.approx(exp, rel=1e-9)


def test_zero_scores_rank_above_negative_matches(spark):
    docs = spark.createDataFrame([("d1", "a b"), ("d2", "a b"), ("d3", "a b"), ("d4", "c")], "doc_id string, text string")
    q = spark.createDataFrame([("q", "a")], "query_id string, text string")
    run = lx.bm25_retrieve(docs, q, 2).orderBy(F.desc("score"), "doc_id").collect()
    assert run[0]["doc_id"] == "d4" and run[0]["score"] == 0 and run[1]["doc_id"] == "d1" and run[1]["score"] < 0


def test_rewritten_documents_give_a_new_index(spark, tmp_path):
    q = spark.createDataFrame([("q", "new")], "query_id string, text string")
    path = str(tmp_path / "docs")
    for text, want in (("old word here", 0.0), ("new word", None)):
        spark.createDataFrame([("d1", text), ("d2", "x y"), ("d3", "z")], "doc_id string, text string").coalesce(1).write.mode("overwrite").parquet(path)
        score = lx.bm25_retrieve(spark.read.parquet(path), q, 1).first()["score"]
        assert score == want if want is not None else score > 0
