"""Paragraph similarity against brute force, best-of-several golds, context order."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from irspark.operators import fuse as FU
from irspark.operators import lexical as lx
from irspark.operators import qa as Q


def _brute(rows, k, within):
    toks = {i: Counter(re.findall("[a-z0-9]+", (t or "").lower())) for i, t, _ in rows}
    df = Counter(t for c in toks.values() for t in c)
    n, group = len(rows), {i: g for i, _, g in rows}
    vec = {}
    for i, c in toks.items():
        w = {t: tf * (math.log((1 + n) / (1 + df[t])) + 1) for t, tf in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        vec[i] = {t: x / norm for t, x in w.items()} if norm else {}
    out = set()
    for a in vec:
        scored = []
        for b in vec:
            if a == b or None in (group[a], group[b]) or (group[a] == group[b]) != within:
                continue
            if vec[a].keys() & vec[b].keys():
                scored.append((-round(sum(x * vec[b].get(t, 0.0) for t, x in vec[a].items()), 6), b))
        out |= {(a, b, round(-s, 5)) for s, b in sorted(scored)[:k]}
    return out


@pytest.mark.parametrize("scope", ["within", "across"])
def test_similar_pairs_brute_force(spark, scope):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    weights = [1.0 / (i + 1) for i in range(60)]  # w0 is in nearly every paragraph
    rows = [(f"p{i:03d}", " ".join(rnd.choices(words, weights, k=rnd.randint(1, 25))), f"g{i % 3}") for i in range(120)]
    rows += [(f"c{i:03d}", "same copied line of words w1 w2", f"g{i % 2}") for i in range(30)]
    rows += [("e1", "", "g0"), ("e2", None, "g1"), ("lone", "unseen", "g2"), ("nogroup", "w0 w1", None)]
    df = spark.createDataFrame(rows, "para_id string, text string, src string")
    got = lx.similar_pairs(df, 3, group_col="src", scope=scope).collect()
    assert {(r["para_a"], r["para_b"], round(r["score"], 5)) for r in got} == _brute(rows, 3, scope == "within")


def test_similar_pairs_without_groups_and_empty(spark):
    rows = [("a", "x y z", None), ("b", "x y", None), ("c", "q", None)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "para_id string, text string")
    assert [(r["para_a"], r["para_b"]) for r in lx.similar_pairs(df, 2).orderBy("para_a").collect()] == [("a", "b"), ("b", "a")]
    assert lx.similar_pairs(df.filter("false"), 2).count() == 0


def test_best_of_several_golds(spark):
    df = spark.createDataFrame([("1", "the red fox", ["blue cat", "Red fox."]), ("2", "red", []), ("3", "red dog", ["red cat", "red dog x"])],
                               "question_id string, prediction string, golds array<string>")
    got = {r["question_id"]: r for r in Q.score_answers(df).collect()}
    assert [got[i]["squad_em"] for i in "123"] == [1.0, 0.0, 0.0]
    assert [round(got[i]["squad_f1"], 6) for i in "123"] == [1.0, 0.0, 0.8]
    vocab = spark.createDataFrame([(t,) for t in "red fox blue cat dog x".split()], "term string")
    sim = {r["question_id"]: r["bertscore_f1"] for r in Q.qa_token_similarity(df, Q.token_vectors_from_hash(vocab)).collect()}
    assert round(sim["1"], 6) == 1.0 and sim["2"] == 0.0 and 0.0 < sim["3"] < 1.0


def test_mixed_context_puts_golds_first(spark):
    docs = spark.createDataFrame([(str(i), f"t{i}") for i in range(4)], "doc_id string, text string")
    run = spark.createDataFrame([("q", "0", 3.0), ("q", "3", 2.0), ("q", "1", 1.0)], "query_id string, doc_id string, score double")
    qrels = spark.createDataFrame([("q", "3", 1), ("q", "2", 1), ("q", "1", 0)], "query_id string, doc_id string, relevance int")
    r = FU.build_context(run, docs, 2, sep="|", mode="mixed", qrels=qrels).first()
    assert (r["context"], r["n_passages"]) == ("t2|t3|t0", 3)


def test_token_similarity_is_the_same_beyond_the_broadcast_bound(spark):
    from irspark.contracts import BROADCAST_MAX_ROWS_CONF

    rnd = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    line = lambda: " ".join(rnd.choices(words, k=rnd.randint(0, 9)))
    rows = [(str(i), line(), [line() if rnd.random() < 0.9 else None for _ in range(rnd.randint(0, 3))]) for i in range(60)]
    df = spark.createDataFrame(rows + [("n", None, None)], "question_id string, prediction string, golds array<string>")
    vectors = spark.createDataFrame([(w, [rnd.gauss(0, 1) for _ in range(4)]) for w in words[:27]], "term string, vec array<double>")
    one = {r["question_id"]: r for r in Q.qa_token_similarity(df, vectors).collect()}
    spark.conf.set(BROADCAST_MAX_ROWS_CONF, "0")
    try:
        two = {r["question_id"]: r for r in Q.qa_token_similarity(df, vectors).collect()}
    finally:
        spark.conf.unset(BROADCAST_MAX_ROWS_CONF)
    assert set(one) == set(two) and len(one) == 61
    for k in one:
        assert [round(x, 9) for x in list(one[k])[1:]] == [round(x, 9) for x in list(two[k])[1:]], k


def test_trained_vectors_tell_related_words_from_others(spark):
    from irspark.functions.text import tok_whitespace
    from irspark.operators.vector import embed_texts

    rnd = random.Random(3)
    topics = [[f"a{i}" for i in range(8)], [f"b{i}" for i in range(8)]]
    docs = spark.createDataFrame([(str(i), " ".join(rnd.choices(topics[i % 2], k=20))) for i in range(300)], "doc_id string, text string")
    model, _ = embed_texts(docs, tok_whitespace, dim=8, max_iter=8)
    df = spark.createDataFrame([("same", "a1 a2", ["a1 a2"]), ("near", "a1 a2", ["a5 a6"]), ("far", "a1 a2", ["b5 b6"])],
                               "question_id string, prediction string, golds array<string>")
    f1 = {r["question_id"]: r["bertscore_f1"] for r in Q.qa_token_similarity(df, Q.word_vectors(model)).collect()}
    assert f1["same"] > 0.999999 and f1["near"] > f1["far"] + 0.2
