"""Steps that are done once, or not multiplied: each failed before on larger tables."""
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from irspark.functions import text as T
from irspark.operators import corpus as C
from irspark.operators import lexical as lx
from irspark.operators.index import build_index

WORDS = [f"w{i}" for i in range(40)]


def texts(n, seed=1, words=WORDS, length=12):
    rng = random.Random(seed)
    return [(str(i), " ".join(rng.choice(words[:1 + int(len(words) * rng.random() ** 2)]) for _ in range(length))) for i in range(n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counted(spark, df):
    """``df`` with its tokens passed through a function that counts the rows it sees."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def through(tokens):
        seen.add(1)
        return tokens
    return df.withColumn("tokens", through("tokens")), seen


def test_grid_is_not_multiplied_before_the_sum(spark):
    docs = spark.createDataFrame(texts(300), "doc_id string, text string")
    queries = spark.createDataFrame([("q1", "w1 w2 w9"), ("q2", "w30 w0"), ("q3", "zzz"), (None, "w3")], "query_id string, text string")
    settings = [(0.9, 0.5), (1.2, 0.75), (1.5, 1.0), (1.2, 0.75)]
    grid = spark.createDataFrame(settings, "k1 double, b double")
    index = build_index(docs)
    scores = lx.bm25_grid_scores(index, queries, grid)
    assert "keys=[k1" not in plan(scores)
    got = {}
    for r in lx.bm25_grid_runs(index, queries, grid, 5).collect():
        got.setdefault((r["k1"], r["b"], r["query_id"]), []).append((-r["score"], r["doc_id"]))
    for k1, b in set(settings):
        want = {}
        for r in lx.bm25_retrieve(index, queries, 5, k1=k1, b=b, fill=False).collect():
            want.setdefault(r["query_id"], []).append((-r["score"], r["doc_id"]))
        assert {q: sorted(rows) for (x, y, q), rows in got.items() if (x, y) == (k1, b)} == {q: sorted(rows) for q, rows in want.items()}


def test_judgments_and_retrieval_share_one_index(spark):
    from irspark.sources import fixtures as fx

    d, q = fx.docs(spark, "/root/testdata/sf0.001"), fx.queries(spark, "/root/testdata/sf0.001")
    build_index(d)
    folder = os.path.join(spark.conf.get("spark.checkpoint.dir"), "irspark-indexes")
    before = set(os.listdir(folder))
    assert fx.containment_pairs(d, q).count() > 0
    assert set(os.listdir(folder)) == before


def test_texts_are_read_once_for_frequencies(spark):
    rows = [(i, "en" if i % 2 else "de", f"w{i % 7}", 1 + i % 3) for i in range(60)]
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def through(n):
        seen.add(1)
        return n
    f = (spark.createDataFrame(rows, "id int, lang string, term string, freq long").withColumn("freq", through("freq"))
         .groupBy("lang", "term").agg(F.sum("freq").alias("freq")))
    assert C.characteristic_words(f, "lang", 3).count() == 6
    assert seen.value == 60
    t = spark.createDataFrame([("a", "x", ["b", "cc", "b"]), ("b", "x", []), ("c", "y", ["d"]), ("d", "z", [])], "doc_id string, variant string, tokens array<string>")
    t, seen = counted(spark, t)
    got = {r["variant"]: r[1:] for r in C.corpus_stats_by(t).collect()}
    assert seen.value < 10                                              # counting their tokens once more makes it ten
    assert got == {"x": (2, 3, 1.5, 2, pytest.approx(4 / 3), 1.5), "y": (1, 1, 1.0, 1, 1.0, 1.0), "z": (1, 0, 0.0, None, None, None)}


def test_texts_are_read_once_for_curves_in_several_orders(spark):
    rows = [(i, "s" + str(i % 2), t.split(), str(97 * i % 50)) for i, (_, t) in enumerate(texts(50))]
    t = spark.createDataFrame(rows, "doc_id int, source string, tokens array<string>, shuf string")
    one = [C.heaps(t, o, [4, 16, 64, 256], ["source"]).collect() for o in ("doc_id", "shuf")]
    t, seen = counted(spark, t)
    both = C.heaps_by_orders(t, ["doc_id", "shuf"], [4, 16, 64, 256], ["source"])
    assert [sorted(b.collect()) for b in both] == [sorted(o) for o in one]
    assert seen.value == 50


def test_word_vectors_train_on_every_core(spark):
    from irspark.operators.vector import embed_texts

    model, v = embed_texts(spark.createDataFrame(texts(60), "doc_id string, text string"), dim=4, max_iter=1)
    assert model.getNumPartitions() == min(64, spark.sparkContext.defaultParallelism) > 1
    assert v.count() == 60


def test_large_mapping_joins_only_rare_tokens(spark, monkeypatch):
    monkeypatch.setattr(T, "HOT_FORMS", 2)
    spark.conf.set("irspark.broadcast.maxRows", "0")
    try:
        df = spark.createDataFrame([("a", ["x", "y", "x"], 1), ("b", ["x", "rare"], 2), (None, ["y", "rare", None], 3), ("c", None, 4)],
                                   "doc_id string, tokens array<string>, _l int")
        mapping = spark.createDataFrame([("x", "X"), ("rare", "R"), ("y", "y")], "term string, mapped string")
        out = T.normalize_terms(df, mapping)
        assert {r["doc_id"]: (r["tokens"], r["_l"]) for r in out.collect()} == {
            "a": (["X", "y", "X"], 1), "b": (["X", "R"], 2), None: (["y", "R", None], 3), "c": ([], 4)}
        assert "LeftAnti, BuildRight" in plan(out)
    finally:
        spark.conf.unset("irspark.broadcast.maxRows")


def test_only_distinct_tokens_become_strings():
    import pyarrow as pa

    from irspark.operators.qa import _places

    at, ends = _places(pa.array([["a", "b", "a"], None, ["z"], []]), {"a": 4, "b": 7})
    assert at.tolist() == [4, 7, 4, -1] and ends.tolist() == [0, 3, 3, 4, 4]
    at, ends = _places(pa.array([[], None], pa.list_(pa.string())), {})
    assert at.tolist() == [] and ends.tolist() == [0, 0, 0]


def test_weights_of_a_corpus_read_its_postings_once(spark):
    docs = spark.createDataFrame(texts(40) + [("0", "w1 w1 extra"), ("e", "")], "doc_id string, text string")
    index = build_index(docs)
    w = lx.bm25_term_weights(index)
    assert plan(w).count("Generate inline") == 1
    p = {(r["doc_id"], r["term"], r["tf"]) for r in index.postings.collect()}
    assert w.count() == index.postings.count()
    n, avg = 42, index.stats.first()["avgdl"]
    df = {r["term"]: r["df"] for r in index.term_df.collect()}
    length = {}
    for d, t in texts(40) + [("0", "w1 w1 extra"), ("e", "")]:
        length[d] = length.get(d, 0) + len(t.split())
    want = sorted((d, t, round(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length[d] / avg)) * math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)), 6)) for d, t, tf in p)
    assert sorted(set((r["doc_id"], r["term"], round(r["weight"], 6)) for r in w.collect())) == sorted(set(want))


def test_toxicity_counts_languages_beyond_the_sample(spark):
    from irspark.llm.toxicity import train_toxicity

    rows = [(i, f"l{i % 30}", ("foul " if i % 2 else "kind ") + f"w{i % 9} own{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(2)
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    model = train_toxicity(docs, labels, max_rows=12)
    assert model.languages == sorted({f"l{i}" for i in range(30)})
    total = np.exp(model.word_log.astype(float)).min(axis=0)             # 0.1 / (0.1 a bucket and all words)
    assert np.allclose(0.1 / total - 6553.6, 30, atol=0.5)               # 10 rows of 3 words: all of them


def test_suffix_tree_keeps_contexts_of_one_in_five_thousand_tokens(spark):
    from irspark.llm.suffix_tree import train_suffix_tree

    rows = texts(500, length=80)
    rows = [(int(d), t + (" rareleft rareright" if int(d) % 50 == 0 else "")) for d, t in rows]
    model, _ = train_suffix_tree(spark.createDataFrame(rows, "doc_id long, text string"))
    assert model.tree.alphabet.symbol[b"rareleft"] in model.tree.contexts[1]


def test_match_sums_are_of_the_run_only(spark):
    from irspark.plans import ltr_q

    docs = spark.createDataFrame(texts(200), "doc_id string, text string")
    queries = spark.createDataFrame([("q1", "w1 w2 w2 w9"), ("q2", "w30 w0"), ("q3", "zzz"), (None, "w3")], "query_id string, text string")
    index = build_index(docs)
    q = lx.bm25_query_side(index, lx.query_terms(queries))
    run = lx.bm25_retrieve(index, queries, 5).checkpoint(eager=True)
    got = {(r["query_id"], r["doc_id"]): r for r in ltr_q._match_sums(index, q, run).collect()}
    top = {(r["query_id"], r["doc_id"]) for r in run.where("score <> 0").collect() if r["query_id"]}
    assert set(got) == top and len(top) == 10
    words = {i: t.split() for i, t in texts(200)}
    for (name, doc), r in got.items():
        own = {"q1": "w1 w2 w2 w9", "q2": "w30 w0"}[name].split()
        assert r["sum_tf"] == sum(words[doc].count(w) for w in own) and r["dl"] == len(words[doc])


def test_bigrams_are_combined_per_document_and_dealt_by_input(spark, monkeypatch):
    from irspark.operators import corpus, index

    folder = spark.conf.get("spark.checkpoint.dir") + "/bigram-texts"
    spark.createDataFrame(texts(400) + [("n", None), ("one", "w1")], "doc_id string, text string").write.mode("overwrite").parquet(folder)
    tokens = spark.read.parquet(folder).select("doc_id", T.tok_alnum(F.col("text")).alias("tokens"))
    monkeypatch.setattr(index, "PIECE_BYTES", 256)
    n = index.piece_count(tokens)
    assert n > 2 * spark.sparkContext.defaultParallelism                # the tasks grow with the files
    out = corpus.bigram_freq(tokens)
    assert out.rdd.getNumPartitions() == n and plan(out).count(f"{n}") >= 2
    want = {}
    for _, t in texts(400):
        for pair in zip(t.split(), t.split()[1:]):
            want[" ".join(pair)] = want.get(" ".join(pair), 0) + 1
    assert {r["bigram"]: r["freq"] for r in out.collect()} == want


def test_only_rare_postings_are_shuffled_for_a_large_vocabulary(spark, monkeypatch):
    from irspark.operators import index as ix

    docs = spark.createDataFrame([(d, t + f" own{d}") for d, t in texts(300)], "doc_id string, text string")
    index = build_index(docs)
    idf, _ = lx.tfidf_weights(index)
    rows = lambda: sorted(map(tuple, index.with_terms(idf).select("doc_id", "term", "tf", "idf").collect()))
    want, sizes, broadcast = rows(), [], F.broadcast
    monkeypatch.setattr(T, "HOT_FORMS", 60)
    monkeypatch.setattr(ix, "HOT_TERMS", 1)                              # no term holds that share
    monkeypatch.setattr(F, "broadcast", lambda df: sizes.append(df.count()) or broadcast(df))
    spark.conf.set("irspark.broadcast.maxRows", "100")                  # of 340 terms, 300 of them in one document
    try:
        assert rows() == want
    finally:
        spark.conf.unset("irspark.broadcast.maxRows")
    frequent = index.term_df.where("df > 2").count()
    assert frequent > 30 and sizes.count(frequent) >= 2                  # the terms and their rows of the table


def test_judgments_are_read_once_and_counted(spark, monkeypatch):
    from irspark.operators import evaluate

    rng = random.Random(5)
    judged = [(f"q{q}", f"d{d}", rng.choice([-1, 0, 0, 1, 1, 2, 3, None])) for q in range(6) for d in range(40)]
    judged += [("q0", "d1", 2), ("q0", "d1", 2), ("gone", "d1", 1), ("zero", "d2", 0), (None, "d1", 1), ("q1", None, 2)]
    run = [(f"q{q}", f"d{d}", float(rng.randrange(8))) for q in range(7) for d in range(0, 60, 3)] + [("q1", None, 3.0)]
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def through(x):
        seen.add(1)
        return x
    qrels = spark.createDataFrame(judged, "query_id string, doc_id string, relevance int").withColumn("relevance", through("relevance"))
    runs = spark.createDataFrame(run, "query_id string, doc_id string, score double")
    metrics = ["P@5", "AP@20", "nDCG@3", "nDCG@20", "nDCG", "R@10", "RR"]
    monkeypatch.setattr(evaluate, "IDEAL_BLOCK", 4)
    got = {r["query_id"]: r for r in evaluate.per_query_metrics(runs, qrels, metrics).collect()}
    assert seen.value == len(judged)
    assert set(got) == {q for q, _, _ in judged}
    for q in got:
        rel = [(d, r) for p, d, r in judged if p == q]
        docs = sorted([(s, d) for p, d, s in run if p == q and q is not None], key=lambda x: (x[0], x[1] or ""), reverse=True)
        ranked = [r or 0 for _, d in docs for r in ([r for e, r in rel if e == d and d is not None] or [0])]
        for cut, name in ((3, "nDCG@3"), (20, "nDCG@20"), (10 ** 6, "nDCG")):
            dcg = lambda g: sum(max(x, 0) / math.log2(i + 2) for i, x in enumerate(g[:cut]))
            ideal = dcg(sorted((r or 0 for _, r in rel), reverse=True))
            assert got[q][name] == pytest.approx(dcg(ranked) / ideal if ideal else 0.0), (q, name)
        n = sum((r or 0) >= 1 for _, r in rel)
        assert got[q]["R@10"] == pytest.approx(sum(x >= 1 for x in ranked[:10]) / n if n else 0.0)


def test_answers_are_normalised_once(spark):
    from irspark.operators import qa

    rows = [("a", "The cat, sat", ["cat sat", "a dog"]), ("b", "", [""]), ("c", None, ["x"]), ("d", "x x y", ["x y y", None]), ("e", "x", []), ("f", "x", None)]
    df = spark.createDataFrame(rows, "question_id string, prediction string, golds array<string>")
    out = qa.score_answers(df)
    assert plan(out).count("a|an|the") <= 4                             # prediction and golds, and the plan's repeats
    got = {r["question_id"]: (r["squad_em"], round(r["squad_f1"], 6), r["em_loose"], r["em_strict"]) for r in out.collect()}
    assert got == {"a": (1.0, 1.0, 1.0, 0.0), "b": (1.0, 1.0, 1.0, 1.0), "c": (0.0, 0.0, 0.0, 0.0),
                   "d": (0.0, 0.666667, 1.0, 0.0), "e": (0.0, 0.0, 0.0, 0.0), "f": (0.0, 0.0, 0.0, 0.0)}
    assert out.columns == ["question_id", "prediction", "golds", "squad_f1", "squad_em", "em_loose", "em_strict"]


def test_ranker_training_reads_its_rows_once(spark):
    from irspark.operators import ltr

    rows = [(f"q{i % 20}", f"d{i}", float(i % 3 == 0), float(i % 7), float(i % 5)) for i in range(200)]
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def through(x):
        seen.add(1)
        return x
    df = spark.createDataFrame(rows, "query_id string, doc_id string, relevance double, f1 double, f2 double").withColumn("f1", through("f1"))
    out = ltr.train_and_evaluate(df, ["f1", "f2"], gbt_iter=2).first()
    assert seen.value == 200 and out["train_size"] + out["eval_size"] == 200
