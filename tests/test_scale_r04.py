"""Work that is done once, or in bounded pieces: each failed before on larger tables."""
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from irspark.functions import text as T
from irspark.operators import corpus as C

ODD = ["Needed NEEDS needing, the of\nKİs 2nd", "", None, "the the the", "s ed ing es", "ss ies cities passes glass", "é s t x\tm"]


def texts(n, seed=1, length=30):
    rng = random.Random(seed)
    words = [f"w{i}" + rng.choice(["", "s", "ed", "ing", "ies"]) for i in range(80)] + ["the", "of"]
    return [" ".join(rng.choice(words) for _ in range(length)) for _ in range(n)] + ODD


@pytest.fixture
def counted_tokens(spark, monkeypatch):
    """The texts that pass through the default tokenizer."""
    seen, tok = spark.sparkContext.accumulator(0), T.tok_alnum

    @F.udf("string")
    def through(text):
        seen.add(1)
        return text
    monkeypatch.setattr(T, "tok_alnum", lambda c: tok(through(c)))
    return seen


def test_variants_of_the_statistics_tokenise_once(spark, tmp_path, counted_tokens):
    from irspark.plans import corpus_q

    values = texts(40)
    rows = [(i, t, "s", "en") for i, t in enumerate(values)] + [(1, values[1], "s", "en"), (None, "the x", "s", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["variant"]: r[1:] for r in corpus_q.q_corpus_stats_by_variant(spark, str(tmp_path)).collect()}
    assert counted_tokens.value == len(rows)
    words = [w for r in rows for w in re.findall("[a-z0-9]+", (r[1] or "").lower())]
    stop = set(corpus_q.fx.STOPWORDS)
    want = {"original": words, "stemmed": [re.sub("(ing|ed|es|s)$", "", w) for w in words], "no_stopwords": [w for w in words if w not in stop]}
    for name, ws in want.items():
        types = set(ws)
        assert got[name] == (len(rows), len(ws), pytest.approx(len(ws) / len(rows), abs=1e-6), len(types),
                             pytest.approx(sum(map(len, ws)) / len(ws), abs=1e-6), pytest.approx(sum(map(len, types)) / len(types), abs=1e-6))


def test_statistics_of_counted_terms(spark):
    rows = [("x", ["b"], 2), ("x", ["cc"], 1), ("y", ["d"], 1), ("y", [], 4)]
    t = spark.createDataFrame(rows, "variant string, tokens array<string>, n long")
    docs = spark.createDataFrame([("x",), ("x",), ("y",), ("z",)], "variant string")
    got = {r["variant"]: r[1:] for r in C.corpus_stats_by(t, count_col="n", docs=docs).collect()}
    assert got == {"x": (2, 3, 1.5, 2, pytest.approx(4 / 3), 1.5), "y": (1, 1, 1.0, 1, 1.0, 1.0), "z": (1, 0, 0.0, None, None, None)}
    assert Counter({r["term"]: r["freq"] for r in C.token_freq(t).collect()}) == Counter("b cc d".split())


def indexed(spark, tmp_path, values, tokenizer):
    from irspark.operators.index import build_index

    rows = [(None if i == 3 else str(i), t) for i, t in enumerate(values)]
    spark.createDataFrame(rows, "doc_id string, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    return build_index(spark.read.parquet(f"{tmp_path}/d"), tokenizer)


def test_tokens_are_counted_in_the_workers_as_by_the_columns(spark, tmp_path):
    from irspark.operators.index import term_arrays, tokenize
    from irspark.plans.retrieval_q import lemma_tok, stem_tok

    values = texts(30)
    docs = spark.createDataFrame([(None if i == 3 else str(i), t) for i, t in enumerate(values)], "doc_id string, text string")
    flat = lambda df: sorted((str(r["doc_id"]), r["dl"], sorted((x["term"], x["tf"]) for x in r["tc"] or [])) for r in df.collect())
    for k, tok in enumerate([T.tok_alnum, T.tok_whitespace, stem_tok, lemma_tok]):
        (tmp_path / str(k)).mkdir()
        index = indexed(spark, tmp_path / str(k), values, tok)
        assert flat(index.rows) == flat(term_arrays(tokenize(docs, "doc_id", "text", tok)))


def test_texts_are_read_once_for_all_variants(spark, tmp_path, monkeypatch):
    from irspark.operators import index as ix
    from irspark.operators import lexical as lx
    from irspark.plans.retrieval_q import VARIANTS

    rows = [(str(i), t) for i, t in enumerate(texts(60))]
    spark.createDataFrame(rows, "doc_id string, text string").write.parquet(f"{tmp_path}/d")
    queries = spark.createDataFrame([("a", "w1s w2 the needing"), ("b", "w30 cities"), (None, "w3"), ("z", "nowhere")], "query_id string, text string")
    read, count = [], ix.counted_terms
    monkeypatch.setattr(ix, "counted_terms", lambda *a: read.append(1) or count(*a))
    monkeypatch.setattr(ix.Index, "by_term", lambda self: pytest.fail("a copy for one batch"))
    for retriever in (lx.bm25_retrieve, lx.tfidf_retrieve):               # the second one finds all indexes written
        got = lx.run_variants(spark.read.parquet(f"{tmp_path}/d"), queries, VARIANTS, 5, retriever).collect()
        assert {r["variant"] for r in got} == set(VARIANTS)
    written = [n for n in VARIANTS if hasattr(VARIANTS[n], "_irspark_base")]
    assert len(read) == 1 and len(written) == 2


def test_block_sums_equal_the_joined_ones(spark, tmp_path, monkeypatch):
    from irspark.operators import lexical as lx
    from irspark.operators import scoring

    values = texts(300) + texts(40, seed=1)                                   # copies tie
    values += ["the common " * 3] * 20
    docs = indexed(spark, tmp_path, values, None)
    rng = random.Random(3)
    queries = [(f"q{i}", " ".join(rng.choice(values[i:i + 40][0].split()) for _ in range(9)) + " the of w1") for i in range(30)]
    queries = spark.createDataFrame(queries + [(None, "w3 the"), ("none", "nowhere"), ("empty", None), ("q1", "w2 of")], "query_id string, text string")
    blocks = []
    whole = lx.best_sums
    monkeypatch.setattr(lx, "best_sums", lambda *a: blocks.append(1) or whole(*a))
    monkeypatch.setattr(scoring, "CELLS", 700)
    for retriever in (lx.bm25_retrieve, lx.tfidf_retrieve):
        for k in (4, 1000):
            blocks.clear()
            got = sorted(map(str, retriever(docs, queries, k).collect()))
            assert blocks
            monkeypatch.setattr(lx, "fits_blocks", lambda *a: False)
            assert got == sorted(map(str, retriever(docs, queries, k).collect()))
            monkeypatch.setattr(lx, "fits_blocks", scoring.fits_blocks)


def test_repeated_ids_are_joined_as_before(spark, tmp_path):
    from irspark.operators import lexical as lx
    from irspark.operators.scoring import fits_blocks

    rows = [("a", "x y"), ("a", "x z"), ("b", "y y")]
    spark.createDataFrame(rows, "doc_id string, text string").write.parquet(f"{tmp_path}/d")
    index = lx.build_index(spark.read.parquet(f"{tmp_path}/d"))
    side = spark.createDataFrame([("q", "x", 1.0)], "query_id string, term string, value double")
    assert not fits_blocks(index, side)
    run = lx.bm25_retrieve(index, spark.createDataFrame([("q", "x")], "query_id string, text string"), 5, fill=False)
    assert [r["doc_id"] for r in run.collect()] == ["a"]


@pytest.mark.parametrize("scope", ["within", "across"])
def test_block_pairs_are_dealt_in_rounds(spark, monkeypatch, scope):
    from irspark.operators import lexical as lx
    from irspark.operators import pairs as P

    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(f"p{i:03d}", " ".join(rng.choices(words, k=rng.randint(1, 12))), f"g{i % 3 if i % 5 else 0}") for i in range(140)]
    df = spark.createDataFrame(rows, "para_id string, text string, src string")
    whole = sorted(map(str, lx.similar_pairs(df, 3, group_col="src", scope=scope).collect()))
    monkeypatch.setattr(P, "BLOCK_ROWS", 20)
    monkeypatch.setattr(P, "ROUND_BYTES", 20_000)
    monkeypatch.setattr(P, "CORE_BYTES", 0)
    copies, made, dealt = [], [], P._round

    def counted(blocks, *run):
        out = dealt(blocks, *run).checkpoint(eager=True)
        sizes = [F.sum(F.size(f"{s}_t") * 8 + F.size(f"{s}_ids") * 64) for s in "lr"]
        copies.append(sum(x or 0 for x in out.agg(*sizes).first()))
        made.append(out.count())
        return out
    monkeypatch.setattr(P, "_round", counted)
    assert sorted(map(str, lx.similar_pairs(df, 3, group_col="src", scope=scope).collect())) == whole
    assert len(copies) > 2 and max(copies) < 30_000 and sum(copies) > 30_000     # at once, as before, it would be the sum
    parts = [7] if scope == "across" else [4, 2, 2]                           # blocks of each zone
    assert sum(made) == sum(n * (n + 1) // 2 for n in parts)
