"""Registered queries: corpus analytics (frequency lists, Zipf, Heaps, bigrams, groups)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import round6
from ..functions import text as T
from ..operators import corpus as C
from ..operators.index import build_index, postings_from_tokens, tokenize
from ..sources import fixtures as fx
from .registry import register
from .text_q import ALN, SW_SQL

TOK = f"SELECT CAST(doc_id AS VARCHAR) doc_id, doc_id doc_num, source, lang, {ALN.format(c='text')} toks FROM documents"
FREQ = f"WITH d AS ({TOK}), f AS (SELECT term, CAST(count(*) AS BIGINT) freq FROM (SELECT unnest(toks) term FROM d) GROUP BY ALL)"


def _tokens(spark, sf):
    return fx.docs(spark, sf).select("doc_id", F.col("doc_id").cast("bigint").alias("doc_num"), "source", "lang", T.tok_alnum(F.col("text")).alias("tokens"))


def _freq(spark, sf):
    return C.word_freq(build_index(fx.docs(spark, sf)).postings)


@register("corpus_stats", FREQ + """, dl AS (SELECT count(*) n_docs, sum(len(toks)) n_tokens FROM d)
SELECT CAST(n_docs AS BIGINT) n_docs, CAST(n_tokens AS BIGINT) n_tokens, round(n_tokens / n_docs, 6) avg_doc_len,
  CAST((SELECT count(*) FROM f) AS BIGINT) n_types,
  round((SELECT sum(freq * length(term))::DOUBLE / sum(freq) FROM f), 6) avg_token_len,
  round((SELECT avg(length(term)) FROM f), 6) avg_type_len FROM dl""")
def q_corpus_stats(spark, sf):
    s = C.corpus_stats(build_index(fx.docs(spark, sf)))
    return s.select("n_docs", "n_tokens", round6("avg_doc_len").alias("avg_doc_len"), "n_types",
                    round6("avg_token_len").alias("avg_token_len"), round6("avg_type_len").alias("avg_type_len"))


_VARIANTS_SQL = f"""WITH d AS ({TOK}),
v AS (SELECT doc_id, 'original' variant, toks FROM d
      UNION ALL SELECT doc_id, 'stemmed', list_transform(toks, lambda w: regexp_replace(w, '(ing|ed|es|s)$', '')) FROM d
      UNION ALL SELECT doc_id, 'no_stopwords', list_filter(toks, lambda x: NOT list_contains({SW_SQL}, x)) FROM d),
f AS (SELECT variant, term, count(*) freq FROM (SELECT variant, unnest(toks) term FROM v) GROUP BY ALL),
dd AS (SELECT variant, count(*) n_docs, sum(len(toks)) n_tokens FROM v GROUP BY ALL),
ff AS (SELECT variant, count(*) n_types, sum(freq * length(term))::DOUBLE / sum(freq) atl, avg(length(term)) atyl FROM f GROUP BY ALL)
SELECT variant, CAST(n_docs AS BIGINT) n_docs, CAST(n_tokens AS BIGINT) n_tokens, round(n_tokens / n_docs, 6) avg_doc_len,
  CAST(n_types AS BIGINT) n_types, round(atl, 6) avg_token_len, round(atyl, 6) avg_type_len FROM dd JOIN ff USING (variant)"""


@register("corpus_stats_by_variant", _VARIANTS_SQL)
def q_corpus_stats_by_variant(spark, sf):
    """The texts are tokenised and counted once; a variant is a rule on terms, so it is made from the vocabulary."""
    t = _tokens(spark, sf).select("doc_id", "tokens")
    w = C.token_freq(t).checkpoint(eager=True).select(F.array("term").alias("tokens"), "freq")
    variants = {"original": F.col("tokens"), "stemmed": F.transform("tokens", T.suffix_stem),
                "no_stopwords": T.remove_stopwords("tokens", fx.STOPWORDS)}
    v = reduce(DataFrame.unionByName, [w.select(F.lit(n).alias("variant"), c.alias("tokens"), "freq") for n, c in variants.items()])
    docs = t.select(F.explode(F.array(*map(F.lit, variants))).alias("variant"))
    s = C.corpus_stats_by(v, "variant", count_col="freq", docs=docs)
    return s.select("variant", "n_docs", "n_tokens", round6("avg_doc_len").alias("avg_doc_len"), "n_types",
                    round6("avg_token_len").alias("avg_token_len"), round6("avg_type_len").alias("avg_type_len"))


@register("word_freq", FREQ + " SELECT term, freq FROM f")
def q_word_freq(spark, sf):
    return _freq(spark, sf)


@register("stopword_mass", FREQ + f""" SELECT CAST(sum(CASE WHEN list_contains({SW_SQL}, term) THEN freq ELSE 0 END) AS BIGINT) stop_tokens,
  CAST(sum(freq) AS BIGINT) all_tokens, CAST(count(CASE WHEN list_contains({SW_SQL}, term) THEN 1 END) AS BIGINT) stop_types_found,
  round(sum(CASE WHEN list_contains({SW_SQL}, term) THEN freq ELSE 0 END)::DOUBLE / sum(freq), 6) stop_share FROM f""")
def q_stopword_mass(spark, sf):
    m = C.stopword_mass(_freq(spark, sf), fx.STOPWORDS)
    return m.select("stop_tokens", "all_tokens", "stop_types_found", round6("stop_share").alias("stop_share"))


@register("top_non_stopwords", FREQ + f""", t AS (SELECT term, freq, row_number() OVER (ORDER BY freq DESC, term) rank FROM f
  ORDER BY freq DESC, term LIMIT 30)
SELECT term, freq, CAST(rank AS INTEGER) rank FROM t WHERE NOT list_contains({SW_SQL}, term)""")
def q_top_non_stopwords(spark, sf):
    return C.top_non_stopwords(_freq(spark, sf), fx.STOPWORDS, 30).select("term", "freq", "rank")


@register("zipf", FREQ + """, ff AS (SELECT freq, count(*) n_terms FROM f GROUP BY ALL),
r AS (SELECT freq, n_terms, coalesce(sum(n_terms) OVER (ORDER BY freq DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 first_rank FROM ff),
z AS (SELECT *, first_rank + n_terms - 1 last_rank, log10(first_rank) log_rank, log10(freq) log_freq FROM r),
fit AS (SELECT regr_slope(log_freq, log_rank) slope, regr_intercept(log_freq, log_rank) intercept FROM z)
SELECT CAST(freq AS BIGINT) freq, CAST(n_terms AS BIGINT) n_terms, CAST(first_rank AS BIGINT) first_rank, CAST(last_rank AS BIGINT) last_rank,
  round(log_rank, 6) log_rank, round(log_freq, 6) log_freq, round(slope, 6) slope, round(intercept, 6) intercept FROM z, fit""")
def q_zipf(spark, sf):
    z = C.zipf(_freq(spark, sf))
    return z.select("freq", "n_terms", "first_rank", "last_rank", *[round6(c).alias(c) for c in
                                                                    ("log_rank", "log_freq", "slope", "intercept")])


def _pow2(limit: int = 1 << 40):
    return [1 << i for i in range(41) if (1 << i) <= limit]


def _heaps_sql(group: str = "", order: str = "doc_num", extra_cols: str = "") -> str:
    gsel = f"{group}, " if group else ""
    gpart = f"PARTITION BY {group} " if group else ""
    gjoin = f"USING ({group})" if group else "ON TRUE"
    return f"""WITH d AS (SELECT *, {order} ord FROM ({TOK})),
o AS (SELECT doc_id, {gsel}coalesce(sum(len(toks)) OVER ({gpart}ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) off FROM d),
p AS (SELECT doc_id, {gsel}unnest(toks) term, generate_subscripts(toks, 1) - 1 pos FROM d),
fp AS (SELECT {gsel}term, min(off + pos) first_pos FROM p JOIN o USING (doc_id{', ' + group if group else ''}) GROUP BY ALL),
tot AS (SELECT {gsel}sum(len(toks)) total FROM d GROUP BY ALL),
cp AS (SELECT unnest({_pow2()}) n_tokens),
g AS (SELECT {gsel}n_tokens FROM tot JOIN cp ON cp.n_tokens <= tot.total),
c AS (SELECT g.*, (SELECT count(*) FROM fp WHERE fp.first_pos < g.n_tokens {('AND fp.' + group + ' = g.' + group) if group else ''}) n_types FROM g),
h AS (SELECT *, log10(n_tokens) log_tokens, log10(n_types) log_types FROM c),
fit AS (SELECT {gsel}regr_slope(log_types, log_tokens) beta FROM h GROUP BY ALL)
SELECT {gsel}{extra_cols}CAST(n_tokens AS BIGINT) n_tokens, CAST(n_types AS BIGINT) n_types, round(log_tokens, 6) log_tokens,
  round(log_types, 6) log_types, round(beta, 6) heaps_beta FROM h JOIN fit {gjoin}"""


def _heaps_out(h, g=()):
    return h.select(*g, "n_tokens", "n_types", *[round6(c).alias(c) for c in ("log_tokens", "log_types", "heaps_beta")])


@register("heaps", _heaps_sql())
def q_heaps(spark, sf):
    t = _tokens(spark, sf)
    return _heaps_out(C.heaps(t, "doc_num", _pow2()))


_VG_SQL = ("SELECT * FROM (" + _heaps_sql("source", "doc_num", "'original' doc_order, ") + ") UNION ALL SELECT * FROM ("
           + _heaps_sql("source", "md5('42|' || doc_id)", "'shuffled' doc_order, ") + ")")


@register("vocab_growth_by_group", _VG_SQL)
def q_vocab_growth_by_group(spark, sf):
    """Heaps curves per source, documents in id order and in a seeded shuffled order."""
    t = _tokens(spark, sf).withColumn("shuf", F.md5(F.concat_ws("|", F.lit("42"), F.col("doc_id"))))
    a, b = (_heaps_out(h, ["source"]) for h in C.heaps_by_orders(t, ["doc_num", "shuf"], _pow2(), ["source"]))
    return a.withColumn("doc_order", F.lit("original")).unionByName(b.withColumn("doc_order", F.lit("shuffled")))


_BG = f"b AS (SELECT bigram, CAST(count(*) AS BIGINT) freq FROM (SELECT unnest(list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])) bigram FROM d) GROUP BY ALL)"


@register("bigram_freq", f"WITH d AS ({TOK}), {_BG} SELECT bigram, freq FROM b")
def q_bigram_freq(spark, sf):
    return C.bigram_freq(_tokens(spark, sf))


@register("bigram_association", FREQ + f""", {_BG}, n AS (SELECT sum(freq)::DOUBLE n FROM f),
bb AS (SELECT bigram, freq, split_part(bigram, ' ', 1) w1, split_part(bigram, ' ', 2) w2 FROM b WHERE freq >= 5)
SELECT bigram, w1, w2, bb.freq, f1.freq c1, f2.freq c2, round(log2(bb.freq * n / (f1.freq::DOUBLE * f2.freq)), 6) pmi,
  round((bb.freq - f1.freq::DOUBLE * f2.freq / n) / sqrt(bb.freq), 6) t_score
FROM bb JOIN f f1 ON f1.term = w1 JOIN f f2 ON f2.term = w2, n""")
def q_bigram_association(spark, sf):
    t = _tokens(spark, sf)
    a = C.bigram_assoc(C.bigram_freq(t), _freq(spark, sf), 5)
    return a.select("bigram", "w1", "w2", "freq", "c1", "c2", round6("pmi").alias("pmi"), round6("t_score").alias("t_score"))


@register("characteristic_words", f"""WITH d AS ({TOK}),
f AS (SELECT lang, term, count(*) freq FROM (SELECT lang, unnest(toks) term FROM d WHERE lang IN ('en', 'de')) GROUP BY ALL),
tot AS (SELECT term, sum(freq) a_w FROM f GROUP BY ALL), a0 AS (SELECT sum(a_w)::DOUBLE a0 FROM tot),
ng AS (SELECT lang, sum(freq)::DOUBLE n_g FROM f GROUP BY ALL),
j AS (SELECT f.lang, f.term, f.freq, freq::DOUBLE y, a_w::DOUBLE aw, a0, n_g FROM f JOIN tot USING (term) JOIN ng USING (lang), a0),
z AS (SELECT lang, term, freq, (ln((y + aw) / (n_g + a0 - y - aw)) - ln((aw - y + aw) / ((a0 - n_g) + a0 - (aw - y) - aw)))
        / sqrt(1.0 / (y + aw) + 1.0 / (aw - y + aw)) z FROM j),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY z DESC, term) rank FROM z)
SELECT lang, term, CAST(freq AS BIGINT) freq, round(z, 6) z, CAST(rank AS INTEGER) rank FROM r WHERE rank <= 20""")
def q_characteristic_words(spark, sf):
    t = _tokens(spark, sf).filter(F.col("lang").isin("en", "de"))
    p = postings_from_tokens(t.select("doc_id", "lang", "tokens"), keep=("lang",))
    f = C.word_freq(p, ["lang"])
    cw = C.characteristic_words(f, "lang", 20)
    return cw.select("lang", "term", "freq", round6("z").alias("z"), "rank")


@register("stylometry_features", f"""WITH d AS ({TOK}),
p AS (SELECT doc_id, term, count(*) tf FROM (SELECT doc_id, unnest(toks) term FROM d) GROUP BY ALL),
pt AS (SELECT doc_id, count(*) n_types, count(CASE WHEN tf = 1 THEN 1 END) hapax FROM p GROUP BY ALL),
b AS (SELECT doc_id, bg, count(*) c FROM (SELECT doc_id, unnest(list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])) bg FROM d) GROUP BY ALL),
bt AS (SELECT doc_id, sum(c) nb, sum(CASE WHEN c > 1 THEN c ELSE 0 END) rep FROM b GROUP BY ALL)
SELECT d.doc_id, CAST(len(toks) AS BIGINT) n_tokens, CAST(coalesce(n_types, 0) AS INTEGER) n_types,
  round(n_types::DOUBLE / nullif(len(toks), 0), 6) ttr,
  round(list_sum(list_transform(toks, lambda x: length(x)))::DOUBLE / nullif(len(toks), 0), 6) mean_word_len,
  round(len(list_filter(toks, lambda x: list_contains({SW_SQL}, x)))::DOUBLE / nullif(len(toks), 0), 6) stop_share,
  round(hapax::DOUBLE / nullif(n_types, 0), 6) hapax_share, round(rep::DOUBLE / nullif(nb, 0), 6) repeated_bigram_share
FROM d LEFT JOIN pt USING (doc_id) LEFT JOIN bt USING (doc_id)""")
def q_stylometry_features(spark, sf):
    s = C.stylometry(_tokens(spark, sf).select("doc_id", "tokens"), fx.STOPWORDS)
    return s.select("doc_id", "n_tokens", "n_types", *[round6(c).alias(c) for c in
                                                       ("ttr", "mean_word_len", "stop_share", "hapax_share", "repeated_bigram_share")])
