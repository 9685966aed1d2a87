import re
import string

from pyspark.sql import functions as F

from irspark.functions import text as T


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("x")).first()["x"]


def test_tokenizers_match_python(spark):
    samples = ["Hello, World! It's 42.", "  Café-au-lait ÉTÉ x2  ", "", "a\tb\nc", None]
    for s in samples:
        assert _one(spark, T.tok_alnum, s) == re.findall(r"[A-Za-z0-9]+", (s or "").lower())
        assert _one(spark, T.tok_whitespace, s) == (s or "").split()


def test_remove_punct_and_stopwords(spark):
    s = "Don't stop: the end-of-line!"
    assert _one(spark, T.remove_punct, s) == "".join(c for c in s if c not in string.punctuation)
    toks = _one(spark, T.tok_simple(["the", "Dont"]), s)
    assert toks == ["stop", "endofline"]  # case-sensitive; punctuation removed first


def test_term_counts_and_empty(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "b"],), ([],)], "t array<string>")
    rows = df.select(T.term_counts("t").alias("c")).collect()
    assert [(r["term"], r["tf"]) for r in rows[0]["c"]] == [("a", 1), ("b", 3), ("c", 1)]
    assert not rows[1]["c"]  # no bogus NULL run for an empty array


def test_bigrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    out = [r["b"] for r in df.select(T.bigrams("t").alias("b")).collect()]
    assert out == [["a b", "b c"], [], []]


def test_normalize_answer_squad(spark):
    def squad(s):
        s = s.lower()
        s = "".join(ch for ch in s if ch not in set(string.punctuation))
        s = re.sub(r"\b(a|an|the)\b", " ", s)
        return " ".join(s.split())

    for s in ["The Cat, a hat!", "An apple an   THE", "éan the", "theatre of the absurd"]:
        assert _one(spark, T.normalize_answer, s) == squad(s)


def test_normalize_terms_join(spark):
    df = spark.createDataFrame([("d1", ["walking", "talked", "cat"]), ("d2", [])], "doc_id string, tokens array<string>")
    mapping = spark.createDataFrame([("walking", "walk"), ("talked", "talk")], "term string, mapped string")
    out = {r["doc_id"]: r["tokens"] for r in T.normalize_terms(df, mapping).collect()}
    assert out == {"d1": ["walk", "talk", "cat"], "d2": []}


def test_first_positions(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "a"],), ([],)], "t array<string>")
    rows = df.select(T.first_positions("t").alias("f")).collect()
    assert sorted((r["term"], r["pos"]) for r in rows[0]["f"]) == [("a", 1), ("b", 0), ("c", 3)]
    assert not rows[1]["f"]
