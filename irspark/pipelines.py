"""Composed experiments: documents, queries and judgments in; runs, metrics and per-query metrics out.

Everything returned is a frame.  Runs that feed several steps are checkpointed once; methods, splits
and alphas are key columns, so that each evaluation is one grouped job.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import bounded_broadcast, id_str, measures_at, require_columns
from .functions.text import tok_whitespace
from .operators import fuse, ltr
from .operators.evaluate import evaluate_run
from .operators.index import build_index
from .operators.lexical import bm25_candidates, bm25_pair_features, bm25_retrieve, tfidf_retrieve
from .operators.rankers import fit_lambda_trees, fit_pairwise
from .operators.sets import concat_splits
from .operators.sparse import combine_features
from .operators.vector import vector_retrieve


@dataclass
class Experiment:
    """runs (keys, query_id, doc_id, score), metrics (keys and one column a measure), per_query."""
    runs: DataFrame
    metrics: DataFrame
    per_query: DataFrame
    ks: list[int]
    depth: int
    details: dict = field(default_factory=dict)


def _checked(docs: DataFrame, queries: DataFrame, qrels: DataFrame) -> None:
    require_columns(docs, {"doc_id", "text"}, "docs_df")
    require_columns(queries, {"query_id", "text"}, "queries_df")
    require_columns(qrels, {"query_id", "doc_id"}, "qrels_df")
    if docs.isEmpty():
        raise ValueError("docs_df is empty")


def _of(frame: DataFrame, queries: DataFrame) -> DataFrame:
    ids = queries.select(id_str("query_id").alias("query_id")).distinct()
    return frame.withColumn("query_id", id_str("query_id")).join(bounded_broadcast(ids), "query_id", "left_semi")


def lexical_experiment(docs: DataFrame, queries: DataFrame, qrels: DataFrame, ks=(1, 10, 20), metrics=None,
                       retrievers: dict | None = None, tokenizer=tok_whitespace) -> Experiment:
    """Every retriever (name -> f(docs, queries, k, tokenizer=...); default BM25 and TF-IDF) to the largest
    of ``ks``, evaluated side by side.  A bare ``P`` or ``nDCG`` among the metrics takes every depth of
    ``ks``.  The key column is ``method``; an empty corpus raises."""
    _checked(docs, queries, qrels)
    ks = sorted({int(k) for k in ks if int(k) > 0})
    if not ks:
        raise ValueError("ks needs a positive depth")
    retrievers = retrievers or {"bm25": bm25_retrieve, "tfidf": tfidf_retrieve}
    runs = concat_splits({n: f(docs, queries, ks[-1], tokenizer=tokenizer) for n, f in retrievers.items()})
    runs = runs.withColumnRenamed("split", "method").checkpoint(eager=True)
    methods = docs.sparkSession.createDataFrame([(n,) for n in retrievers], "method string")
    table, per_query = evaluate_run(runs, qrels, measures_at(metrics, ks), per_query=True, group_cols=["method"], groups=methods)
    return Experiment(runs, table, per_query, ks, ks[-1])


def hybrid_experiment(docs: DataFrame, queries: DataFrame, qrels: DataFrame, doc_vectors: DataFrame, query_vectors: DataFrame,
                      k: int = 100, alpha: float | str | None = "tune", train_split: str = "train", metric: str = "nDCG@20",
                      scorer: Column | object | None = None, rerank_k: int = 50, metrics=None, tokenizer=None) -> Experiment:
    """BM25 and vector runs of all queries, mixed and re-ranked, evaluated for each (split, run_name).

    ``queries`` has a ``split`` column.  ``alpha``: a weight, 'tune' (chosen on the queries of
    ``train_split`` alone) or None (no mixing: the vector run goes on).  ``scorer`` re-ranks the first
    ``rerank_k`` of the mixed run; None leaves that step out.  ``details`` has ``alpha`` and ``alphas``,
    the tuning table.  A split without judged queries yields no row."""
    _checked(docs, queries, qrels)
    require_columns(queries, {"split"}, "queries_df")
    spark = docs.sparkSession
    bm25 = bm25_retrieve(docs, queries, k, tokenizer).checkpoint(eager=True)
    vector = vector_retrieve(query_vectors, doc_vectors, k).checkpoint(eager=True)
    details: dict = {}
    if alpha == "tune":
        train = queries.where(F.col("split") == train_split)
        best, details["alphas"] = fuse.tune_alpha(_of(bm25, train), _of(vector, train), _of(qrels, train), metric=metric)
        alpha = best.first()["alpha"]
    details["alpha"] = alpha
    runs = {"bm25": bm25, "vector": vector}
    last = vector
    if alpha is not None:
        last = runs["mixed"] = fuse.mix_runs(bm25, vector, alpha).checkpoint(eager=True)
    if scorer is not None:
        # its scores are on another scale than those of the rows kept, so the order is the score
        runs["reranked"] = fuse.rerank_run(last, queries, docs, scorer, rerank_k).select(
            "query_id", "doc_id", (-F.col("rank")).cast("double").alias("score"))
    split = bounded_broadcast(queries.select(id_str("query_id").alias("query_id"), "split").distinct())
    all_runs = concat_splits(runs).withColumnRenamed("split", "run_name").join(split, "query_id").checkpoint(eager=True)
    judged = qrels.withColumn("query_id", id_str("query_id")).join(split, "query_id").checkpoint(eager=True)
    groups = (judged.select("split").distinct()
              .crossJoin(F.broadcast(spark.createDataFrame([(n,) for n in runs], "run_name string"))))
    table, per_query = evaluate_run(all_runs, judged, metrics, per_query=True, group_cols=["split", "run_name"], groups=groups)
    return Experiment(all_runs, table, per_query, [k], k, details)


def _lambda_trees(train: DataFrame, cols: list[str], rounds: int, seed: int):
    learn, watch, _ = ltr.group_split(train, "query_id", 0.8, seed + 1)
    return fit_lambda_trees(learn, cols, evaluation=watch, rounds=rounds)


def ltr_experiment(docs: DataFrame, queries: DataFrame, qrels: DataFrame, depth: int = 20, eval_split: float = 0.3,
                   seed: int = 42, methods=("linear", "pairwise"), metrics=("P@10", "nDCG@20"), gbt_iter: int = 200,
                   tokenizer=None) -> Experiment:
    """Learned re-ranking, judged on queries that no model has seen.

    BM25 candidates get features and labels; whole queries go to training or evaluation; imputer, scaler
    and rankers ('linear', 'gbt', 'pairwise', 'pairwise_sparse', 'lambda') learn from the balanced training candidates and order the
    candidates of the evaluation queries.  'pairwise' is the linear scorer of the preference pairs, 'lambda'
    the trees boosted on nDCG@20, which learn from whole candidate lists and stop by a fifth of the training queries.  'pairwise_sparse' adds the BM25
    weights of a pair's shared terms as sparse columns to the linear scorer.  The key column is
    ``method``; 'bm25' is the order before and 'hash' an order that knows nothing.  ``details`` has the split (query_id, split)."""
    _checked(docs, queries, qrels)
    cands = bm25_candidates(docs, queries, depth, tokenizer).checkpoint(eager=True)   # for features of both kinds
    rows, names = ltr.add_ltr_features(cands, tokenizer=tokenizer)
    rows = ltr.add_relevance_labels(rows, qrels).drop("query_text", "doc_text").checkpoint(eager=True)
    cols = ltr.bm25_feature_columns(rows) + names
    train, held, split = ltr.group_split(rows, "query_id", 1.0 - eval_split, seed)
    lists, held = train.checkpoint(eager=True), held.checkpoint(eager=True)
    train = ltr.balanced_sample(lists).checkpoint(eager=True)
    if train.isEmpty():
        raise ValueError("no training query has a relevant candidate")
    _, kept, (train, ready, lists) = ltr.impute_mean(train, cols, [held, lists])
    _, (train, ready, lists) = ltr.scale_features(train, kept, True, [ready, lists])
    fit = {"linear": lambda: ltr.fit_linear_ranker(ltr.assemble(train, kept)),
           "gbt": lambda: ltr.fit_gbt_ranker(ltr.assemble(train, kept), max_iter=gbt_iter),
           "pairwise": lambda: fit_pairwise(train, kept), "lambda": lambda: _lambda_trees(lists, kept, gbt_iter, seed)}
    runs = {"bm25": held.select("query_id", "doc_id", F.col("bm25_1").alias("score")),
            "hash": held.select("query_id", "doc_id", F.xxhash64("query_id", "doc_id").cast("double").alias("score"))}
    for name in methods:
        if name == "pairwise_sparse":
            terms = bm25_pair_features(cands, build_index(docs, tokenizer), tokenizer)
            both = combine_features(train, kept, terms, [ready])
            model = fit_pairwise(both.frames[0], kept, sparse=("idx", "val"), n_columns=both.n_columns, l2=1e-2)
            runs[name] = model.scores(both.frames[1], ("idx", "val")).select("query_id", "doc_id", F.col("prediction").alias("score"))
            continue
        model = fit[name]()
        scored = model.scores(ready) if name in ("pairwise", "lambda") else model.transform(ltr.assemble(ready, kept))
        runs[name] = scored.select("query_id", "doc_id", F.col("prediction").alias("score"))
    all_runs = concat_splits(runs).withColumnRenamed("split", "method").checkpoint(eager=True)
    judged = _of(qrels, split.where("split = 'eval'"))
    groups = docs.sparkSession.createDataFrame([(n,) for n in runs], "method string")
    table, per_query = evaluate_run(all_runs, judged, list(metrics), per_query=True, group_cols=["method"], groups=groups)
    return Experiment(all_runs, table, per_query, [depth], depth, {"split": split})
