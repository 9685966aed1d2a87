"""Registered queries: learning-to-rank features, labels, sampling, splits, preprocessing
and Spark ML rankers (the last ones are rows-only checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import bounded_broadcast, round6
from ..functions import text as T
from ..operators import corpus as C
from ..operators import lexical as lx
from ..operators import ltr as L
from ..operators import rankers as RK
from ..operators import sparse as SP
from ..pipelines import ltr_experiment
from ..sources import fixtures as fx
from . import sql as S
from .fusion_q import BM25_ALL
from .registry import register
from .retrieval_q import LUCENE_WEIGHTS

FEATS = [f"f{i}" for i in range(1, 12)]

_PAIRS = f"""{BM25_ALL},
c AS (SELECT r.query_id, r.doc_id, r.score bm25_1, regexp_extract_all(lower(b.text), '[a-z0-9]+') qt2,
        regexp_extract_all(lower(dd.text), '[a-z0-9]+') dt2 FROM run r
      JOIN benchmark b ON CAST(b.item_id AS VARCHAR) = r.query_id JOIN documents dd ON CAST(dd.doc_id AS VARCHAR) = r.doc_id),
cb AS (SELECT *, list_transform(range(1, len(qt2)), lambda i: qt2[i] || ' ' || qt2[i + 1]) qb,
        list_transform(range(1, len(dt2)), lambda i: dt2[i] || ' ' || dt2[i + 1]) db FROM c),
pp AS (SELECT query_id, doc_id, t, p FROM (SELECT query_id, doc_id, qt2, unnest(dt2) t, generate_subscripts(dt2, 1) p FROM c) WHERE list_contains(qt2, t)),
pl AS (SELECT *, lag(t) OVER w pt, lag(p) OVER w pp_ FROM pp WINDOW w AS (PARTITION BY query_id, doc_id ORDER BY p)),
f3 AS (SELECT query_id, doc_id, min(CASE WHEN pt IS NOT NULL AND pt <> t THEN p - pp_ END) md FROM pl GROUP BY ALL),
feat AS (SELECT cb.query_id, cb.doc_id, cb.bm25_1,
  len(qt2)::DOUBLE f1, len(dt2)::DOUBLE f2, coalesce(f3.md, len(dt2))::DOUBLE f3,
  len(list_intersect(qt2, dt2))::DOUBLE f4, coalesce(len(list_intersect(qt2, dt2))::DOUBLE / nullif(len(qt2), 0), 0) f5,
  len(list_filter(qt2, lambda x: list_contains(dt2, x)))::DOUBLE f6,
  coalesce(len(list_filter(qt2, lambda x: list_contains(dt2, x)))::DOUBLE / nullif(len(dt2), 0), 0) f7,
  len(list_intersect(qb, db))::DOUBLE f8, len(list_filter(qb, lambda x: list_contains(db, x)))::DOUBLE f9,
  CASE WHEN len(qb) = 0 THEN 0 ELSE coalesce(len(list_intersect(qb, db))::DOUBLE / nullif(len(list_distinct(db)), 0), 0) END f10,
  CASE WHEN len(db) = 0 THEN 0 ELSE len(list_filter(qb, lambda x: list_contains(db, x)))::DOUBLE / len(db) END f11
  FROM cb LEFT JOIN f3 USING (query_id, doc_id))"""


def candidates(spark, sf, depth=20):
    return lx.bm25_candidates(fx.docs(spark, sf), fx.queries(spark, sf), depth)


def feature_table(spark, sf):
    df, names = L.add_ltr_features(candidates(spark, sf))
    return df, names


def _feat_query(i: int):
    name = f"f{i}"

    def q(spark, sf):
        df, _ = feature_table(spark, sf)
        return df.select("query_id", "doc_id", round6(name).alias(name))
    return q


_FEATURE_NAMES = {1: "f_query_length", 2: "f_doc_length", 3: "f_min_term_distance", 4: "f_n_intersecting",
                  5: "f_frac_intersecting", 6: "f_n_hits", 7: "f_frac_hits", 8: "f_bigram_overlap", 9: "f_bigram_hits",
                  10: "f_bigram_overlap_frac", 11: "f_bigram_hits_frac"}
for _i, _n in _FEATURE_NAMES.items():
    register(_n, f"WITH {_PAIRS} SELECT query_id, doc_id, round(f{_i}, 6) f{_i} FROM feat")(_feat_query(_i))


@register("ltr_feature_table", f"WITH {_PAIRS} SELECT query_id, doc_id, bm25_1, " + ", ".join(f"round(f{i}, 6) f{i}" for i in range(1, 12)) + " FROM feat")
def q_ltr_feature_table(spark, sf):
    df, names = feature_table(spark, sf)
    cols = L.bm25_feature_columns(df) + names
    return df.select("query_id", "doc_id", *[round6(c).alias(c) for c in cols])


_LINKS = "links AS (SELECT CAST(page_id AS VARCHAR) page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) target FROM pages)"


@register("inlink_counts", f"WITH {_LINKS} SELECT target, CAST(count(*) AS BIGINT) inlinks FROM links GROUP BY ALL")
def q_inlink_counts(spark, sf):
    return L.inlink_counts(fx.page_links(spark, sf))


@register("doc_prior_features", f"""WITH {BM25_ALL}, {_LINKS},
v AS (SELECT CAST(user_id AS VARCHAR) doc_id, count(*) views FROM events WHERE event_type = 'view' GROUP BY ALL),
il AS (SELECT target, count(*) inlinks FROM links GROUP BY ALL)
SELECT r.query_id, r.doc_id, coalesce(v.views, 0)::DOUBLE views, coalesce(il.inlinks, 0)::DOUBLE inlinks
FROM run r LEFT JOIN v USING (doc_id) LEFT JOIN il ON il.target = '/' || r.doc_id""")
def q_doc_prior_features(spark, sf):
    """Page views (events of type view per user id, standing in for page id) and in-links
    (link targets '/<doc_id>') joined to the BM25 run; 0 when missing."""
    run = lx.bm25_retrieve(fx.docs(spark, sf), fx.queries(spark, sf), 20)
    links = fx.page_links(spark, sf).withColumn("target", F.regexp_replace("target", "^/", ""))
    out = L.add_doc_priors(run, fx.page_views(spark, sf), L.inlink_counts(links))
    return out.select("query_id", "doc_id", "views", "inlinks")


_LABELLED = f"""{BM25_ALL}, {S.QRELS_FIX},
lab AS (SELECT r.query_id, r.doc_id, r.score, coalesce(q.relevance, 0)::DOUBLE relevance FROM run r LEFT JOIN qrels q USING (query_id, doc_id))"""


def labelled(spark, sf):
    run = lx.bm25_retrieve(fx.docs(spark, sf), fx.queries(spark, sf), 20)
    return L.add_relevance_labels(run, fx.qrels(spark, sf))


@register("label_candidates", f"WITH {_LABELLED} SELECT query_id, doc_id, score, relevance FROM lab")
def q_label_candidates(spark, sf):
    return labelled(spark, sf).select("query_id", "doc_id", "score", "relevance")


@register("balanced_sample", f"""WITH {_LABELLED},
pc AS (SELECT query_id, count(*) p FROM lab WHERE relevance > 0 GROUP BY ALL),
neg AS (SELECT lab.*, row_number() OVER (PARTITION BY query_id ORDER BY md5('42|' || query_id || '|' || doc_id)) r, p FROM lab JOIN pc USING (query_id) WHERE relevance <= 0)
SELECT query_id, doc_id, relevance FROM lab WHERE relevance > 0 UNION ALL SELECT query_id, doc_id, relevance FROM neg WHERE r <= p""")
def q_balanced_sample(spark, sf):
    return L.balanced_sample(labelled(spark, sf)).select("query_id", "doc_id", "relevance")


@register("group_split", f"""WITH {BM25_ALL}, g AS (SELECT DISTINCT query_id FROM run),
r AS (SELECT query_id, row_number() OVER (ORDER BY md5('42|' || query_id)) rk, count(*) OVER () n FROM g)
SELECT query_id, CASE WHEN rk <= floor(n * 0.7) THEN 'train' ELSE 'eval' END split FROM r""")
def q_group_split(spark, sf):
    run = lx.bm25_retrieve(fx.docs(spark, sf), fx.queries(spark, sf), 20)
    _, _, labels = L.group_split(run, "query_id", 0.7, 42)
    return labels


@register("impute_mean", f"""WITH {_PAIRS}, x AS (SELECT query_id, doc_id, CASE WHEN f3 = f2 THEN NULL ELSE f3 END f3n FROM feat)
SELECT query_id, doc_id, round(coalesce(f3n, (SELECT avg(f3n) FROM x)), 6) f3 FROM x""")
def q_impute_mean(spark, sf):
    """f3 is NULL where fewer than two query terms matched (f3 = f2); NULLs take the mean."""
    df, _ = feature_table(spark, sf)
    df = df.withColumn("f3", F.when(F.col("f3") == F.col("f2"), F.lit(None)).otherwise(F.col("f3")))
    _, kept, (out,) = L.impute_mean(df.select("query_id", "doc_id", "f3"), ["f3"])
    return out.select("query_id", "doc_id", round6("f3").alias("f3"))


@register("scale_features", f"""WITH {_PAIRS}, m AS (SELECT avg(f1) m1, stddev_pop(f1) s1, avg(f2) m2, stddev_pop(f2) s2, avg(f6) m6, stddev_pop(f6) s6 FROM feat)
SELECT query_id, doc_id, round((f1 - m1) / CASE WHEN s1 > 0 THEN s1 ELSE 1 END, 6) f1,
  round((f2 - m2) / CASE WHEN s2 > 0 THEN s2 ELSE 1 END, 6) f2, round((f6 - m6) / CASE WHEN s6 > 0 THEN s6 ELSE 1 END, 6) f6 FROM feat, m""")
def q_scale_features(spark, sf):
    df, _ = feature_table(spark, sf)
    _, (out,) = L.scale_features(df.select("query_id", "doc_id", "f1", "f2", "f6"), ["f1", "f2", "f6"])
    return out.select("query_id", "doc_id", *[round6(c).alias(c) for c in ("f1", "f2", "f6")])


@register("pairwise_ranker", f"""WITH {_PAIRS}, {S.QRELS_FIX},
lab AS (SELECT feat.*, coalesce(q.relevance, 0)::DOUBLE relevance FROM feat LEFT JOIN qrels q USING (query_id, doc_id)),
cent AS (SELECT query_id, relevance lc, avg(f4) m4, avg(f6) m6 FROM lab GROUP BY ALL)
SELECT lab.query_id, lab.doc_id, lab.relevance label, cent.lc other_label, CASE WHEN lab.relevance > cent.lc THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END pref,
  round(f4 - m4, 6) f4, round(f6 - m6, 6) f6 FROM lab JOIN cent ON cent.query_id = lab.query_id AND cent.lc <> lab.relevance""")
def q_pairwise_ranker(spark, sf):
    """The pairwise training table (document minus the centroid of each other label class of
    its query).  ``ltr_rerank_eval`` fits the model on it and judges it on held-out queries."""
    df, _ = feature_table(spark, sf)
    lab = L.add_relevance_labels(df, fx.qrels(spark, sf))
    p = L.preference_pairs(lab, ["f4", "f6"])
    return p.select("query_id", "doc_id", "label", "other_label", "pref", round6("f4").alias("f4"), round6("f6").alias("f6"))


def _judged_features(spark, sf):
    df, names = feature_table(spark, sf)
    lab = L.add_relevance_labels(df, fx.qrels(spark, sf))
    return lab, L.bm25_feature_columns(lab) + names


_DENSE = ["bm25_1", "f2", "f6"]


@register("combine_dense_sparse", f"""WITH {_PAIRS}, {LUCENE_WEIGHTS},
long AS (SELECT feat.query_id, feat.doc_id, q.term, w.weight * q.qtf v FROM feat JOIN q USING (query_id) JOIN w ON w.doc_id = feat.doc_id AND w.term = q.term),
m AS (SELECT count(*)::DOUBLE n, """ + ", ".join(f"stddev_pop({c}) s_{c}" for c in _DENSE) + f""" FROM feat),
tv AS (SELECT term, sum(v * v) / n s2, sum(v * v) / n - (sum(v) / n) * (sum(v) / n) var FROM long, m GROUP BY term, n),
tc AS (SELECT term, CASE WHEN var > 1e-12 * s2 THEN sqrt(var) ELSE 1 END s, {len(_DENSE)} - 1 + row_number() OVER (ORDER BY term) c FROM tv)
SELECT query_id, doc_id, CAST(c AS INTEGER) "column", term AS name, round(v / s, 6) AS value FROM long JOIN tc USING (term)
""" + "".join(f"UNION ALL SELECT query_id, doc_id, {i}, '{c}', round({c} / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6) FROM feat, m\n"
              for i, c in enumerate(_DENSE)))
def q_combine_dense_sparse(spark, sf):
    """Every entry of the combined, scaled features of the BM25 candidates: dense columns first, then the
    BM25 weights of the shared terms as sparse columns."""
    cands = candidates(spark, sf)
    dense, _ = L.add_ltr_features(cands)
    both = SP.combine_features(dense, _DENSE, lx.bm25_pair_features(cands, lx.build_index(fx.docs(spark, sf))))
    entry = lambda i, v: F.struct(F.lit(i).alias("column"), F.col(v).alias("value"))
    entries = F.concat(F.array(*[entry(i, c) for i, c in enumerate(_DENSE)]),
                       F.zip_with("idx", "val", lambda i, v: F.struct(i.alias("column"), v.alias("value"))))
    rows = both.frames[0].select("query_id", "doc_id", F.inline(entries))
    return rows.join(both.columns.select("column", "name"), "column").select("query_id", "doc_id", "column", "name", round6("value").alias("value"))


_RANKED = f"""{_LABELLED}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) rk FROM lab)"""


@register("pairwise_gradient", f"""WITH {_LABELLED}
SELECT a.query_id, a.doc_id, 0.0 + round(sum(CASE WHEN a.relevance > b.relevance THEN -1 / (1 + exp(least(a.score - b.score, 700)))
  WHEN a.relevance < b.relevance THEN 1 / (1 + exp(least(b.score - a.score, 700))) ELSE 0 END), 6) AS gradient
FROM lab a JOIN lab b USING (query_id) GROUP BY a.query_id, a.doc_id""")
def q_pairwise_gradient(spark, sf):
    """Gradient by score of the pairwise logistic loss at the BM25 scores of the labelled candidates."""
    g = RK.pair_gradients(labelled(spark, sf))
    return g.select("query_id", "doc_id", (round6("gradient") + F.lit(0.0)).alias("gradient"))


@register("lambda_gradient", f"""WITH {_RANKED},
gd AS (SELECT *, CASE WHEN rk <= 10 THEN 1 / log2(rk + 1) ELSE 0 END disc FROM r),
i AS (SELECT query_id, sum(relevance / log2(ik + 1)) ideal FROM (SELECT query_id, relevance, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC) ik FROM lab)
      WHERE ik <= 10 GROUP BY query_id)
SELECT a.query_id, a.doc_id, 0.0 + round(sum(CASE WHEN ideal = 0 OR a.relevance = b.relevance THEN 0 ELSE
  (CASE WHEN a.relevance > b.relevance THEN -1 / (1 + exp(least(a.score - b.score, 700))) ELSE 1 / (1 + exp(least(b.score - a.score, 700))) END)
  * abs((a.relevance - b.relevance) * (a.disc - b.disc)) / ideal END), 6) AS gradient
FROM gd a JOIN gd b USING (query_id) JOIN i USING (query_id) GROUP BY a.query_id, a.doc_id""")
def q_lambda_gradient(spark, sf):
    """Gradient of nDCG@10 by swaps at the BM25 scores of the labelled candidates."""
    g = RK.lambda_gradients(labelled(spark, sf), 10)
    return g.select("query_id", "doc_id", (round6("gradient") + F.lit(0.0)).alias("gradient"))


@register("ltr_listwise_eval")
def q_ltr_listwise_eval(spark, sf):
    """Held-out quality of the preference rankers beside the linear one, the BM25 order and a hash order."""
    done = ltr_experiment(fx.docs(spark, sf), fx.queries(spark, sf), fx.qrels(spark, sf), gbt_iter=30,
                          methods=("linear", "gbt", "pairwise", "pairwise_sparse", "lambda"))
    return done.metrics.select("method", *[round6(F.col(f"`{c}`")).alias(c) for c in ("P@10", "nDCG@20")])


@register("linear_ranker")
def q_linear_ranker(spark, sf):
    lab, cols = _judged_features(spark, sf)
    s = L.balanced_sample(lab)
    model = L.fit_linear_ranker(L.assemble(s, cols))
    p = model.transform(L.assemble(lab, cols))
    return p.select("query_id", "doc_id", round6("prediction").alias("prediction"))


@register("gbt_ranker")
def q_gbt_ranker(spark, sf):
    lab, cols = _judged_features(spark, sf)
    s = L.balanced_sample(lab)
    model = L.fit_gbt_ranker(L.assemble(s, cols), max_iter=200)
    p = model.transform(L.assemble(lab, cols))
    return p.select("query_id", "doc_id", round6("prediction").alias("prediction"))


@register("train_evaluate_rankers")
def q_train_evaluate_rankers(spark, sf):
    lab, cols = _judged_features(spark, sf)
    return L.train_and_evaluate(L.balanced_sample(lab), cols, gbt_iter=200)


@register("ltr_rerank_eval")
def q_ltr_rerank_eval(spark, sf):
    """The composed experiment: linear and pairwise rankers learned on 70 % of the judged queries,
    evaluated on the others, beside the BM25 order and an order that knows nothing."""
    done = ltr_experiment(fx.docs(spark, sf), fx.queries(spark, sf), fx.qrels(spark, sf))
    return done.metrics.select("method", *[round6(F.col(f"`{c}`")).alias(c) for c in ("P@10", "nDCG@20")])


def _match_sums(idx, q, run):
    """Sums over the matching terms of each (query, document) of the run.  Only postings of its pairs are summed,
    so no other pair is ever shuffled."""
    m = (idx.matching(q, bounded_broadcast(run.select("doc_id").distinct()))
         .join(bounded_broadcast(run.select("query_id", "doc_id").distinct()), ["query_id", "doc_id"], "left_semi"))
    return m.groupBy("query_id", "doc_id").agg(F.sum(F.col("qtf") * F.col("tf")).alias("sum_tf"),
                                               F.sum(F.col("qtf") * F.col("idf")).alias("sum_idf"),
                                               F.sum(F.col("qtf") * F.col("tf") * F.col("idf")).alias("sum_tfidf"),
                                               F.max("dl").alias("dl"))


@register("reconstruct_bm25")
def q_reconstruct_bm25(spark, sf):
    """Learn the BM25 score from per-pair aggregates of term frequency, idf and document
    length (linear model) on 70 % of the queries; report R^2 there and the correlation of
    predicted and true scores on the others."""
    docs, qs = fx.docs(spark, sf), fx.queries(spark, sf)
    idx = lx.build_index(docs)
    qt = lx.query_terms(qs)
    q = lx.bm25_query_side(idx, qt)
    run = lx.bm25_retrieve(idx, qs, 20).checkpoint(eager=True)
    agg = _match_sums(idx, q, run)
    x = run.join(agg, ["query_id", "doc_id"]).withColumnRenamed("score", "relevance").checkpoint(eager=True)   # split and fitted
    cols = ["sum_tf", "sum_idf", "sum_tfidf", "dl"]
    train, held, _ = L.group_split(x, "query_id", 0.7, 42)
    model = L.fit_linear_ranker(L.assemble(train, cols))
    p = model.transform(L.assemble(held, cols))
    return p.agg(F.corr("prediction", "relevance").alias("corr"), F.lit(model.summary.r2).alias("r2"),
                 F.count(F.lit(1)).alias("n_pairs"))


@register("generated_text_detector")
def q_generated_text_detector(spark, sf):
    """Stylometric features + logistic regression predicting the ``quality`` label; split by
    id hash; accuracy and F1 on the held-out part."""
    from pyspark.ml.classification import LogisticRegression

    t = fx.docs(spark, sf).select("doc_id", T.tok_alnum(F.col("text")).alias("tokens"))
    st = C.stylometry(t, fx.STOPWORDS)
    lab = fx.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    cols = ["n_tokens", "n_types", "ttr", "mean_word_len", "stop_share", "hapax_share", "repeated_bigram_share"]
    x = st.join(lab, "doc_id").na.fill(0.0, cols)
    x = x.withColumn("_test", (F.abs(F.xxhash64("doc_id")) % 10) < 3)
    tr, te = x.filter(~F.col("_test")), x.filter(F.col("_test"))
    model = LogisticRegression(featuresCol="features", labelCol="y", maxIter=50).fit(L.assemble(tr, cols))
    p = model.transform(L.assemble(te, cols))
    tp = F.sum(((F.col("prediction") == 1) & (F.col("y") == 1)).cast("double"))
    fp = F.sum(((F.col("prediction") == 1) & (F.col("y") == 0)).cast("double"))
    fn = F.sum(((F.col("prediction") == 0) & (F.col("y") == 1)).cast("double"))
    return p.agg(F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("accuracy"),
                 F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"), F.count(F.lit(1)).alias("n_test"))
