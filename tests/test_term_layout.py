import random
import re

import pytest
from pyspark.sql import functions as F

from irspark.functions.text import tok_whitespace
from irspark.operators import index as ix
from irspark.operators import lexical as lx


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents that all hold the word 'all', so its postings fill several files."""
    rng = random.Random(7)
    vocabulary = [f"w{i:04d}" for i in range(3000)]
    rows = [(f"d{i:05d}", " ".join(["all"] * rng.randint(1, 3) + rng.choices(vocabulary, k=rng.randint(1, 40)) + [f"only{i}"]))
            for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(8)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ix, "CHUNK_POSTINGS", 3000)
        index = ix.build_index(docs, tok_whitespace)
        index.by_term()
    return index


def leaves(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return leaves(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return leaves(plan.plan())
    if name == "FileSourceScanExec":
        return [plan]
    return [x for i in range(plan.children().size()) for x in leaves(plan.children().apply(i))]


def scanned(df):
    """(bytes of the files chosen, rows that the scans returned, text of the scans) of one run."""
    df.collect()
    scans = leaves(df._jdf.queryExecution().executedPlan())
    value = lambda s, m: s.metrics().apply(m).value()
    return sum(value(s, "filesSize") for s in scans), sum(value(s, "numOutputRows") for s in scans), " ".join(s.toString() + s.simpleString(1000) for s in scans)


QUERIES = [("rare", "only17 w0003"), ("pair", "w1200 w1201 w2999 nowhere"), ("none", "nowhere"), ("empty", None)]


def test_layouts_give_the_same_rows(spark, corpus):
    queries = spark.createDataFrame(QUERIES + [("common", "all only5 w0100")], "query_id string, text string")
    got = {}
    for layout in ("documents", "terms"):
        spark.conf.set(ix.LAYOUT_CONF, layout)
        try:
            got[layout] = [sorted(map(tuple, f(corpus, queries, 7, tok_whitespace).collect()))
                           for f in (lx.bm25_retrieve, lx.tfidf_retrieve)]
        finally:
            spark.conf.unset(ix.LAYOUT_CONF)
    assert got["documents"] == got["terms"] and len(got["terms"][0]) == 35


def test_small_batches_read_their_terms_only(spark, corpus):
    side = spark.createDataFrame([("only17",), ("w0003",), ("w1200",), ("w1201",), ("w2999",), ("nowhere",)], "term string")
    some = corpus.lookup(side)
    assert some is not None
    files, rows, text = scanned(some)
    whole_files, whole_rows, _ = scanned(corpus.postings.groupBy().count())
    assert re.search(r"PartitionFilters: \[\(?chunk#\d+ (IN|=)", text), text
    assert "PushedFilters: [" in text and "EqualTo(term,only17)" in text
    assert files < whole_files / 2
    asked = corpus.term_df.join(side, "term").agg(F.sum("df")).first()[0]
    assert some.join(F.broadcast(side), "term").count() == asked


def test_choice_by_share_of_postings(spark, corpus):
    term = lambda *t: spark.createDataFrame([(x,) for x in t], "term string")
    assert corpus.lookup(term("w0001")) is not None
    every = corpus.term_df.select("term")
    assert corpus.lookup(every) is None                                   # all postings: the forward index
    assert corpus.lookup(term("nowhere")).count() == 0
    lazy = ix.build_index(spark.createDataFrame([("d", "a b")], "doc_id string, text string"), tok_whitespace, materialize=False)
    assert lazy.lookup(term("a")) is None


def test_files_split_a_frequent_term_and_hold_every_posting(spark, corpus):
    table, files = corpus.by_term()
    assert sum(first <= "all" <= last for _, first, last in files) >= 2
    assert [f[1:] for f in files] == sorted(f[1:] for f in files)
    same = corpus.postings.select("term", "doc_id", "tf", "dl")
    assert table.select("term", "doc_id", "tf", "dl").exceptAll(same).isEmpty()
    assert same.exceptAll(table.select("term", "doc_id", "tf", "dl")).isEmpty()
    assert table.where(F.col("term") == "all").count() == 4000


@pytest.mark.parametrize("n", [1, 64, 65, 700])
def test_intervals(spark, n):
    words = sorted(f"t{i:04d}" for i in range(n))
    files = [(0, "a", "t0000"), (1, "t0000", "t0050"), (2, "t0051", "u"), (3, "v", "z")]
    rows = spark.createDataFrame([(w, c) for w in words + ["zz", "aa"] for c in range(4)], "term string, chunk int")
    kept = {tuple(r) for r in rows.where(ix._term_filter(words, files)).collect()}
    assert all(c != 3 for _, c in kept) and {w for w, _ in kept} == set(words)
