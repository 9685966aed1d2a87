"""Registered queries: tokenisers and text transforms over the whole document texts.

Each returns (doc_id, n, h) where h = md5 of the token list joined by one space (or of the
transformed text), so whole texts are compared exactly."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import fixtures as fx
from .registry import register

PUNCT_SQL = T.PUNCTUATION.replace("'", "''")
SW_SQL = "[" + ", ".join(f"'{w}'" for w in fx.STOPWORDS) + "]"
WS = "list_filter(string_split_regex({c}, '\\s+'), lambda x: x <> '')"
ALN = "regexp_extract_all(lower({c}), '[a-z0-9]+')"


def _tok_out(df, arr):
    return df.select("doc_id", F.size(arr).cast("bigint").alias("n"), F.md5(F.array_join(arr, " ")).alias("h"))


def _sql_tok(expr):
    return f"SELECT CAST(doc_id AS VARCHAR) doc_id, CAST(len(t) AS BIGINT) n, md5(array_to_string(t, ' ')) h FROM (SELECT doc_id, {expr} t FROM documents)"


@register("tok_whitespace", _sql_tok(WS.format(c="text")))
def q_tok_whitespace(spark, sf):
    d = fx.docs(spark, sf)
    return _tok_out(d, T.tok_whitespace(F.col("text")))


@register("tok_alnum", _sql_tok(ALN.format(c="text")))
def q_tok_alnum(spark, sf):
    d = fx.docs(spark, sf)
    return _tok_out(d, T.tok_alnum(F.col("text")))


@register("remove_punctuation", f"SELECT CAST(doc_id AS VARCHAR) doc_id, CAST(length(t) AS BIGINT) n, md5(t) h FROM (SELECT doc_id, translate(text, '{PUNCT_SQL}', '') t FROM documents)")
def q_remove_punctuation(spark, sf):
    d = fx.docs(spark, sf)
    t = T.remove_punct(F.col("text"))
    return d.select("doc_id", F.length(t).cast("bigint").alias("n"), F.md5(t).alias("h"))


@register("remove_stopwords", _sql_tok(f"list_filter({WS.format(c='text')}, lambda x: NOT list_contains({SW_SQL}, x))"))
def q_remove_stopwords(spark, sf):
    d = fx.docs(spark, sf)
    return _tok_out(d, T.remove_stopwords(T.tok_whitespace(F.col("text")), fx.STOPWORDS))


_SIMPLE_SQL = f"list_filter({WS.format(c=chr(39) + chr(39))}, lambda x: NOT list_contains({SW_SQL}, x))"
_SIMPLE = f"list_filter(list_filter(string_split_regex(translate(text, '{PUNCT_SQL}', ''), '\\s+'), lambda x: x <> ''), lambda x: NOT list_contains({SW_SQL}, x))"


# Stop words by language: the words of at most three letters that more than one in five of its documents hold.
_FREQ_SQL = f"""WITH t AS (SELECT doc_id, lang, {WS.format(c="coalesce(text, '')")} toks FROM documents),
n AS (SELECT lang, count(*) n FROM t WHERE lang IS NOT NULL GROUP BY ALL),
w AS (SELECT lang, w, count(*) c FROM (SELECT lang, unnest(list_distinct(toks)) w FROM t) GROUP BY ALL),
sw AS (SELECT lang, list(w) l FROM w JOIN n USING (lang) WHERE c * 5 > n AND length(w) <= 3 GROUP BY lang),
f AS (SELECT CAST(doc_id AS VARCHAR) doc_id, list_filter(toks, lambda x: NOT list_contains(coalesce(l, []), x)) t FROM t LEFT JOIN sw USING (lang))
SELECT doc_id, CAST(len(t) AS BIGINT) n, md5(array_to_string(t, ' ')) h FROM f"""


@register("remove_stopwords_by_language", _FREQ_SQL)
def q_remove_stopwords_by_language(spark, sf):
    """Each document loses the short words that are frequent in its own language, from a table."""
    toks = fx.docs(spark, sf).select("doc_id", "lang", T.tok_whitespace(F.col("text")).alias("tokens"))
    n = toks.where("lang IS NOT NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = toks.select("lang", F.explode(F.array_distinct("tokens")).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("c"))
    words = counts.join(n, "lang").where((F.col("c") * 5 > F.col("n")) & (F.length("word") <= 3)).select("lang", "word")
    return _tok_out(T.remove_stopword_table(toks, words.checkpoint(eager=True), lang_col="lang"), F.col("tokens"))


@register("tok_simple", _sql_tok(_SIMPLE))
def q_tok_simple(spark, sf):
    d = fx.docs(spark, sf)
    return _tok_out(d, T.tok_simple(fx.STOPWORDS)(F.col("text")))


@register("normalize_terms_stem", _sql_tok(f"list_transform({_SIMPLE}, lambda w: regexp_replace(w, '(ing|ed|es|s)$', ''))"))
def q_normalize_terms_stem(spark, sf):
    """Mapping table derived from the corpus vocabulary by the suffix rule, then joined."""
    d = fx.docs(spark, sf)
    toks = d.select("doc_id", T.tok_simple(fx.STOPWORDS)(F.col("text")).alias("tokens"))
    vocab = toks.select(F.explode("tokens").alias("term")).distinct()
    mapping = vocab.select("term", T.suffix_stem(F.col("term")).alias("mapped"))
    out = T.normalize_terms(toks, mapping)
    return _tok_out(out, F.col("tokens"))


@register("bigrams", "SELECT CAST(doc_id AS VARCHAR) doc_id, CAST(len(b) AS BIGINT) n, md5(array_to_string(b, '|')) h FROM "
          f"(SELECT doc_id, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) b FROM (SELECT doc_id, {ALN.format(c='text')} t FROM documents))")
def q_bigrams(spark, sf):
    d = fx.docs(spark, sf)
    b = T.bigrams(T.tok_alnum(F.col("text")))
    return d.select("doc_id", F.size(b).cast("bigint").alias("n"), F.md5(F.array_join(b, "|")).alias("h"))


_ART = "regexp_replace({x}, '(^|[^\\pL\\pN_])(a|an|the)([^\\pL\\pN_]|$)', '\\1 \\3', 'g')"
_NORM = ("trim(regexp_replace(" + _ART.format(x=_ART.format(x=f"translate(lower(text), '{PUNCT_SQL}', '')")) + ", '\\s+', ' ', 'g'))")


@register("normalize_answer", f"SELECT CAST(doc_id AS VARCHAR) doc_id, CAST(length(t) AS BIGINT) n, md5(t) h FROM (SELECT doc_id, {_NORM} t FROM documents)")
def q_normalize_answer(spark, sf):
    d = fx.docs(spark, sf)
    t = T.normalize_answer(F.col("text"))
    return d.select("doc_id", F.length(t).cast("bigint").alias("n"), F.md5(t).alias("h"))


def lemma_rule(c):
    """Stand-in lemma table rule: plural -> singular ('ies' -> 'y', a final 's' after a
    letter other than 's' dropped)."""
    return F.regexp_replace(F.regexp_replace(c, "ies$", "y"), "([^s])s$", "$1")


_IES_END, _S_END = re.compile(r"ies$"), re.compile(r"([^s])s$")


def lemma_of(word: str) -> str:
    """``lemma_rule`` of a token."""
    return _S_END.sub(r"\1", _IES_END.sub("y", word))


@register("normalize_terms_lemma", _sql_tok(f"list_transform({_SIMPLE}, lambda w: regexp_replace(regexp_replace(w, 'ies$', 'y'), '([^s])s$', '\\1'))"))
def q_normalize_terms_lemma(spark, sf):
    """Same vocabulary job as the stem variant with a lemma-style mapping table."""
    d = fx.docs(spark, sf)
    toks = d.select("doc_id", T.tok_simple(fx.STOPWORDS)(F.col("text")).alias("tokens"))
    vocab = toks.select(F.explode("tokens").alias("term")).distinct()
    mapping = vocab.select("term", lemma_rule(F.col("term")).alias("mapped"))
    out = T.normalize_terms(toks, mapping)
    return _tok_out(out, F.col("tokens"))
