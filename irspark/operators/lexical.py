"""Lexical retrieval: BM25 (Okapi, rank-bm25 conventions), TF-IDF cosine, Lucene-idf BM25
term weights, parameter grids, multi-field BM25.

Join shape for every scorer: query terms (small, size-checked broadcast) join postings on
``term`` map-side, so posting lists are never shuffled by term (no term skew); the per
(query, doc) sum is a partial+final aggregate; top-k uses a WindowGroupLimit.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import bounded_broadcast, id_str, require_columns, round6, text_or_empty
from .common import attach_scalars, ranked_run, top_k
from .evaluate import evaluate_run
from .index import Index, build_index, postings_from_tokens, tokenize
from .pairs import best_partners
from .ranking import global_rank
from .scoring import best_sums, fits_blocks

RUN_SCHEMA = "query_id string, doc_id string, score double"


def _as_index(docs_or_index, tokenizer) -> Index:
    if isinstance(docs_or_index, Index):
        return docs_or_index
    require_columns(docs_or_index, {"doc_id", "text"}, "docs")
    index = build_index(docs_or_index, tokenizer)
    if not index.stats.select("n_docs").first()["n_docs"]:
        raise ValueError("docs is empty")
    return index


def query_terms(queries: DataFrame, tokenizer=None, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """(query_id, term, qtf, qlen): repeated query tokens counted, computed in-row."""
    require_columns(queries, {id_col, text_col}, "queries")
    toks = tokenize(queries, id_col, text_col, tokenizer)
    if id_col != "query_id":
        toks = toks.withColumnRenamed(id_col, "query_id")
    return (postings_from_tokens(toks, "query_id")
            .withColumnRenamed("tf", "qtf").withColumnRenamed("dl", "qlen"))


def empty_run(spark) -> DataFrame:
    return spark.createDataFrame([], RUN_SCHEMA)


# ------------------------------------------------------------------------------- BM25

def bm25_idf(index: Index, epsilon: float = 0.25, terms: DataFrame | None = None) -> DataFrame:
    """rank-bm25 Okapi idf: ln(N-df+.5) - ln(df+.5); a negative idf is replaced by
    epsilon * (mean idf over the WHOLE vocabulary, negatives included; kept in index stats).

    ``terms`` restricts the output (not the mean) to a small term set.
    """
    raw = F.ln(F.col("n_docs") - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)
    sub = index.term_df if terms is None else index.term_df.join(terms, "term", "left_semi")
    sub = attach_scalars(sub, index.stats.select("n_docs", "mean_okapi_idf")).withColumn("raw_idf", raw)
    return sub.select("term", "df", F.when(F.col("raw_idf") < 0, F.lit(epsilon) * F.col("mean_okapi_idf"))
                      .otherwise(F.col("raw_idf")).alias("idf"))


def _bm25_tf_part(k1: float, b: float):
    tf, dl = F.col("tf").cast("double"), F.col("dl").cast("double")
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / F.col("avgdl")))


def _bm25_weight(k1: float, b: float, avgdl: float):
    return lambda tf, dl: tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def bm25_query_side(index: Index, qterms: DataFrame, epsilon: float = 0.25) -> DataFrame:
    """(query_id, term, qtf, idf) for query terms found in the vocabulary; checkpointed once
    and broadcast when proven small."""
    qvocab = qterms.select("term").distinct()
    idf = bm25_idf(index, epsilon, terms=qvocab)
    return bounded_broadcast(qterms.join(idf, "term").select("query_id", "term", "qtf", "idf"), checkpoint=True)


def bm25_matched(index: Index, qterms: DataFrame, k1: float = 1.2, b: float = 0.75,
                 epsilon: float = 0.25, q: DataFrame | None = None, docs: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id, term, contribution) for every posting that matches a query term, of the documents
    ``docs`` (doc_id) only if given."""
    q = bm25_query_side(index, qterms, epsilon) if q is None else q
    return _contributions(index, index.matching(q) if docs is None else index.matching(q, docs), k1, b)


def _contributions(index: Index, matched: DataFrame, k1: float, b: float) -> DataFrame:
    m = attach_scalars(matched, index.stats.select("avgdl"))
    contrib = F.col("qtf") * F.col("idf") * _bm25_tf_part(k1, b)
    return m.select("query_id", "doc_id", "term", contrib.alias("contribution"))


def _first_unmatched(index: Index, ids: DataFrame, scores: DataFrame, k: int) -> DataFrame:
    """(query_id, doc_id) of the first ``k`` documents, by id, that do not match each query of ``ids``.

    Documents are numbered by id.  If the i-th match of a query has number p, p - i documents before it do not match;
    so the first k without a match lie among the first k + c, c being the matches with p - i < k.  A query
    gets no more rows than its matches and k."""
    numbered = global_rank(index.doc_len.select("doc_id"), [], ["doc_id"], "_p").checkpoint(eager=True)
    matched = scores.join(ids, "query_id", "left_semi").select("query_id", "doc_id").join(numbered, "doc_id").select("query_id", "_p")
    matched = matched.checkpoint(eager=True)
    i = F.row_number().over(Window.partitionBy("query_id").orderBy("_p"))
    c = matched.select("query_id", (F.col("_p") - i < k).cast("int").alias("_in")).groupBy("query_id").agg(F.sum("_in").alias("_c"))
    places = ids.join(c, "query_id", "left").select(
        "query_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(k) + F.coalesce("_c", F.lit(0).cast("bigint")))).alias("_p"))
    return places.join(matched, ["query_id", "_p"], "left_anti").join(numbered, "_p").select("query_id", "doc_id")


def _fill_zero_docs(index: Index, queries_ids: DataFrame, top: DataFrame, k: int, scores: DataFrame) -> DataFrame:
    """Reference ranks every document, so a query with fewer than k matches is padded with
    score-0 documents (lowest doc ids first) up to min(k, N) rows.

    ``top`` is the already cut top-k run (|Q| x k rows, checkpointed).  A query short of k
    rows there has ALL its matches in it, so the pad is: the first 2k doc ids (TakeOrdered,
    bounded) minus that query's rows.  Only short queries get a pad; the final cut is a
    second top-k over at most |Q| x 3k rows.

    When the mean Okapi idf is negative, matches may score below the documents without a match.
    A query with such a row in its top-k is padded with its first k documents without a match."""
    counts = top.groupBy("query_id").agg(F.count(F.lit(1)).alias("m"))
    short = (queries_ids.join(counts, "query_id", "left")
             .filter(F.coalesce(F.col("m"), F.lit(0)) < k).select("query_id"))
    first_docs = index.doc_len.select("doc_id").orderBy("doc_id").limit(2 * k)
    # short queries x a 2k-row constant table: bounded by the output size (|Q| x 2k)
    pad = (short.crossJoin(F.broadcast(first_docs))
           .join(top.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
           .withColumn("score", F.lit(0.0)))
    run = top.select("query_id", "doc_id", "score").unionByName(pad)
    below = top.filter(F.col("score") < 0).select("query_id").distinct().checkpoint(eager=True)
    if not below.isEmpty():
        zeros = _first_unmatched(index, below, scores, k).withColumn("score", F.lit(0.0))
        run = run.unionByName(top_k(zeros, ["query_id"], [F.col("doc_id").asc()], k, None)).distinct()
    return ranked_run(run, k)


def bm25_retrieve(docs_or_index, queries: DataFrame, k: int = 10, tokenizer=None,
                  k1: float = 1.2, b: float = 0.75, epsilon: float = 0.25,
                  fill: bool = True) -> DataFrame:
    """Okapi BM25 top-k per query -> run (query_id, doc_id, score)."""
    require_columns(queries, {"query_id", "text"}, "queries")
    spark = queries.sparkSession
    if k <= 0:
        return empty_run(spark)
    index = _as_index(docs_or_index, tokenizer)
    q = bm25_query_side(index, query_terms(queries, tokenizer), epsilon)
    some = index.lookup(q)
    m = _contributions(index, index.joined(some, q), k1, b)
    scores = m.groupBy("query_id", "doc_id").agg(F.sum("contribution").alias("score"))
    if some is None and fits_blocks(index, q):
        avgdl = index.stats.select("avgdl").first()["avgdl"]
        side = q.select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("value"))
        top = ranked_run(best_sums(index.rows, side, "value", _bm25_weight(k1, b, avgdl), k), k)
    else:
        top = ranked_run(scores, k)
    if not fill:
        return top
    qids = queries.select(id_str("query_id").alias("query_id")).distinct()
    return _fill_zero_docs(index, qids, top.checkpoint(eager=True), k, scores)


def bm25_score_pairs(pairs: DataFrame, docs_or_index, tokenizer=None, k1: float = 1.2, b: float = 0.75,
                     epsilon: float = 0.25, score_col: str = "bm25_1", query_text_col: str = "query_text") -> DataFrame:
    """Add a BM25 score to given (query_id, doc_id) pairs; pairs without a match score 0.
    One query text per query id (the smallest, for determinism)."""
    require_columns(pairs, {"query_id", query_text_col, "doc_id"}, "candidates_df")
    index = _as_index(docs_or_index, tokenizer)
    p = pairs.withColumn("query_id", id_str("query_id")).withColumn("doc_id", id_str("doc_id"))
    qtext = p.groupBy("query_id").agg(F.min(query_text_col).alias("text"))
    qterms = query_terms(qtext, tokenizer)
    keys = p.select("query_id", "doc_id").distinct().checkpoint(eager=True)
    m = bm25_matched(index, qterms, k1, b, epsilon, docs=bounded_broadcast(keys.select("doc_id").distinct()))
    s = (m.join(keys, ["query_id", "doc_id"], "left_semi")
         .groupBy("query_id", "doc_id").agg(F.sum("contribution").alias(score_col)))
    return (p.drop(score_col).join(s, ["query_id", "doc_id"], "left")
            .withColumn(score_col, round6(F.coalesce(F.col(score_col), F.lit(0.0)))))


def bm25_candidates(docs: DataFrame, queries: DataFrame, depth: int, tokenizer=None, k1: float = 1.2,
                    b: float = 0.75, epsilon: float = 0.25, score_col: str = "bm25_1") -> DataFrame:
    """Top-``depth`` BM25 candidates with query and document text joined after the cut."""
    require_columns(docs, {"doc_id", "text"}, "corpus_df")
    require_columns(queries, {"query_id", "text"}, "queries_df")
    if depth <= 0:
        raise ValueError("retrieval_depth must be positive")
    run = bm25_retrieve(docs, queries, depth, tokenizer, k1, b, epsilon)
    run = bounded_broadcast(run)
    dtext = docs.select(id_str("doc_id").alias("doc_id"), text_or_empty("text").alias("doc_text"))
    qtext = queries.select(id_str("query_id").alias("query_id"), text_or_empty("text").alias("query_text"))
    return (run.join(dtext, "doc_id").join(qtext, "query_id")
            .select("query_id", "query_text", "doc_id", "doc_text", F.col("score").alias(score_col)))


def run_variants(docs: DataFrame, queries: DataFrame, tokenizers: dict, k: int = 10, retriever=None) -> DataFrame:
    """Same queries against several collection variants (original / stemmed / ...), each
    query processed with the variant's own tokenizer.  Output adds a ``variant`` column.  One batch
    asks each index, so no copy of it is sorted by term for that."""
    retriever = retriever or bm25_retrieve
    runs = [retriever(replace(_as_index(docs, t), copied=False), queries, k, tokenizer=t).withColumn("variant", F.lit(name))
            for name, t in tokenizers.items()]
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out


# ------------------------------------------------------------------------------ TF-IDF

def _smooth_idf() -> F.Column:
    return F.ln((F.col("n_docs") + 1) / (F.col("df") + 1)) + 1


def tfidf_weights(index: Index) -> tuple[DataFrame, DataFrame]:
    """scikit-learn TfidfVectorizer defaults: idf = ln((1+N)/(1+df)) + 1, raw tf, L2 norm.
    Returns (idf table, document norms)."""
    idf = attach_scalars(index.term_df, index.stats.select("n_docs")).select("term", _smooth_idf().alias("idf"))

    def norms_of(ix):
        # postings x full-vocabulary idf, summed per document; corpus-level, so it is written once
        # next to the index.  With an idf table within the broadcast bound nothing is shuffled
        # (postings are bucketed by doc_id); beyond it only the postings of rarer terms are.
        return (ix.with_terms(idf)
                .groupBy("doc_id").agg(F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("dnorm")))

    return idf, index.derived("tfidf_norms", norms_of)


def tfidf_retrieve(docs_or_index, queries: DataFrame, k: int = 10, tokenizer=None, fill: bool = True) -> DataFrame:
    """Cosine similarity of TF-IDF vectors, top-k per query (unseen query terms ignored)."""
    require_columns(queries, {"query_id", "text"}, "queries")
    if k <= 0:
        return empty_run(queries.sparkSession)
    index = _as_index(docs_or_index, tokenizer)
    idf, norms = tfidf_weights(index)
    qterms = query_terms(queries, tokenizer)
    # idf restricted to the query vocabulary first; the query side is checkpointed once and
    # broadcast when proven small
    qidf = idf.join(qterms.select("term").distinct(), "term", "left_semi")
    qw = qterms.join(qidf, "term").withColumn("qw", F.col("qtf") * F.col("idf"))
    qnorm = qw.groupBy("query_id").agg(F.sqrt(F.sum(F.col("qw") ** 2)).alias("qnorm"))
    qw = bounded_broadcast(qw.join(qnorm, "query_id").select("query_id", "term", "qw", "idf", "qnorm"), checkpoint=True)
    some = index.lookup(qw)
    m = index.joined(some, qw)
    dot = m.groupBy("query_id", "doc_id").agg(F.sum(F.col("qw") * F.col("tf") * F.col("idf")).alias("dot"),
                                              F.max("qnorm").alias("qnorm"))
    scores = (dot.join(norms, "doc_id")
              .select("query_id", "doc_id", F.try_divide(F.col("dot"), F.col("qnorm") * F.col("dnorm")).alias("score")))
    if some is None and fits_blocks(index, qw):
        side = qw.select("query_id", "term", (F.col("qw") * F.col("idf") / F.col("qnorm")).alias("value"))
        rows = index.rows.join(norms.hint("shuffle_hash"), "doc_id").select("doc_id", "dl", "tc", "dnorm")
        top = ranked_run(best_sums(rows, side, "value", _raw_tf, k), k)
    else:
        top = ranked_run(scores, k)
    if not fill:
        return top
    qids = queries.select(id_str("query_id").alias("query_id")).distinct()
    return _fill_zero_docs(index, qids, top.checkpoint(eager=True), k, scores)


def _raw_tf(tf, dl):
    return tf


# ------------------------------------------------------------- sparse BM25 term weights

def bm25_term_weights(fitted: Index, docs: DataFrame | None = None, tokenizer=None,
                      k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Per (doc, term) BM25 weight with Lucene idf ln(1 + (N-df+.5)/(df+.5)).

    ``fitted`` supplies vocabulary, df, N and avgdl (1.0 when 0).  ``docs`` (default: the
    fitted corpus) are transformed with that vocabulary: out-of-vocabulary tokens are
    dropped and the document length counts only in-vocabulary tokens.
    """
    idf = (attach_scalars(fitted.term_df, fitted.stats.select("n_docs", "avgdl"))
           .select("term", F.ln(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"),
                   F.when(F.coalesce(F.col("avgdl"), F.lit(0.0)) > 0, F.col("avgdl")).otherwise(F.lit(1.0)).alias("avgdl")))
    if docs is None:
        # the vocabulary holds every term of its own corpus: lengths are those of the index, whose bucketing both share
        dl = fitted.doc_len.groupBy("doc_id").agg(F.sum("dl").alias("vdl"))
        p = fitted.with_terms(idf, fitted.postings.select("doc_id", "term", "tf").join(dl, "doc_id"))
    else:
        p = postings_from_tokens(tokenize(docs, "doc_id", "text", tokenizer)).select("doc_id", "term", "tf")
        p = fitted.with_terms(idf, p)  # drops out-of-vocabulary terms
        p = p.join(bounded_broadcast(p.groupBy("doc_id").agg(F.sum("tf").alias("vdl")), checkpoint=True), "doc_id")
    tf = F.col("tf").cast("double")
    w = tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("vdl") / F.col("avgdl"))) * F.col("idf")
    return p.select("doc_id", "term", w.alias("weight"))


def bm25_pair_features(pairs: DataFrame, fitted: Index, tokenizer=None, k1: float = 1.2, b: float = 0.75,
                       query_text_col: str = "query_text", doc_text_col: str = "doc_text") -> DataFrame:
    """Long-form sparse pair features: (query_id, doc_id, term, value = doc weight x query tf).
    Row sum over terms is the Lucene-idf BM25 score of the pair."""
    require_columns(pairs, {"query_id", query_text_col, "doc_id", doc_text_col}, "candidates_df")
    p = pairs.withColumn("query_id", id_str("query_id")).withColumn("doc_id", id_str("doc_id"))
    dsub = p.groupBy("doc_id").agg(F.min(doc_text_col).alias("text"))
    qsub = p.groupBy("query_id").agg(F.min(query_text_col).alias("text"))
    dw = bm25_term_weights(fitted, dsub, tokenizer, k1, b)
    qt = query_terms(qsub, tokenizer).join(fitted.term_df.select("term"), "term", "left_semi")
    qt = qt.checkpoint(eager=True)
    # lengths are counted by now: only the weights of the queries' terms go on to their pairs
    dw = dw.join(bounded_broadcast(qt.select("term").distinct()), "term", "left_semi")
    keys = p.select("query_id", "doc_id").distinct()
    return (keys.join(qt, "query_id").join(dw, ["doc_id", "term"])
            .select("query_id", "doc_id", "term", (F.col("weight") * F.col("qtf")).alias("value")))


# ------------------------------------------------------------------------ parameter grid

def _grid_sums(docs_or_index, queries: DataFrame, grid: DataFrame, tokenizer, epsilon: float) -> tuple[DataFrame, list]:
    """(query_id, doc_id, s0, s1, ...), one score a setting, and the settings (k1, b) as literals.  The matched rows
    are not multiplied by the grid, and the forward index is read, so that the sums need no shuffle."""
    index = _as_index(docs_or_index, tokenizer)
    q = bm25_query_side(index, query_terms(queries, tokenizer), epsilon)
    kinds = [grid.schema[c].dataType for c in ("k1", "b")]
    rows = dict.fromkeys((r["k1"], r["b"]) for r in grid.select("k1", "b").collect())   # a few dozen rows
    settings = [tuple(F.lit(v).cast(t) for v, t in zip(r, kinds)) for r in rows]
    m = attach_scalars(index.postings.join(q, "term"), index.stats.select("avgdl"))
    tf, dl = F.col("tf").cast("double"), F.col("dl").cast("double")
    sums = [F.sum(F.col("qtf") * F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / F.col("avgdl")))).alias(f"s{i}")
            for i, (k1, b) in enumerate(settings)]
    return m.groupBy("query_id", "doc_id").agg(*sums), settings


def _by_setting(sums: DataFrame, settings: list, keep=lambda i: F.lit(True)) -> DataFrame:
    """(k1, b, query_id, doc_id, score) of the scores that ``keep`` asks for."""
    rows = F.array(*[F.struct(k1.alias("k1"), b.alias("b"), F.col(f"s{i}").alias("score"), keep(i).alias("_in"))
                     for i, (k1, b) in enumerate(settings)])
    return sums.select("query_id", "doc_id", F.inline(F.filter(rows, lambda r: r["_in"]))).select("k1", "b", "query_id", "doc_id", "score")


def bm25_grid_scores(docs_or_index, queries: DataFrame, grid: DataFrame, tokenizer=None,
                     epsilon: float = 0.25) -> DataFrame:
    """Score every (k1, b) setting in one pass over the matched (query, doc, term) rows, all settings of a pair
    side by side in one row until they are summed.  -> (k1, b, query_id, doc_id, score)."""
    return _by_setting(*_grid_sums(docs_or_index, queries, grid, tokenizer, epsilon))


def bm25_grid_runs(docs_or_index, queries: DataFrame, grid: DataFrame, k: int, tokenizer=None,
                   epsilon: float = 0.25) -> DataFrame:
    """Top-k of every query and setting.  The documents of a query are dealt to 4k bins; the k-th largest of the bins'
    best scores is a lower bound of the k-th best score, and only scores that reach it are sorted."""
    sums, settings = _grid_sums(docs_or_index, queries, grid, tokenizer, epsilon)
    names = [f"s{i}" for i in range(len(settings))]
    sums = sums.select("query_id", "doc_id", *[round6(c).alias(c) for c in names]).checkpoint(eager=True)
    best = (sums.groupBy("query_id", F.pmod(F.xxhash64("doc_id"), F.lit(4 * max(k, 1))).alias("_bin"))
            .agg(*[F.max(c).alias(c) for c in names]))
    bound = best.groupBy(F.col("query_id").alias("_q")).agg(
        *[F.get(F.sort_array(F.collect_list(c), False), F.lit(max(k, 1) - 1)).alias(f"t{i}") for i, c in enumerate(names)])
    rows = sums.join(bounded_broadcast(bound, checkpoint=True), F.col("query_id").eqNullSafe(F.col("_q")))
    reach = lambda i: F.col(f"t{i}").isNull() | F.coalesce(F.col(f"s{i}") >= F.col(f"t{i}"), F.lit(False))
    some = F.lit(False)
    for i in range(len(settings)):
        some = some | reach(i)
    s = _by_setting(rows.where(some), settings, reach)
    return top_k(s, ["k1", "b", "query_id"], [F.col("score").desc(), F.col("doc_id").asc()], k, None).checkpoint(eager=True)


def tune_bm25(docs_or_index, queries: DataFrame, qrels: DataFrame, grid: DataFrame, metric: str = "nDCG@20",
              k: int = 20, tokenizer=None, epsilon: float = 0.25) -> tuple[float, float, DataFrame]:
    """(k1, b, table): the first setting, in the order of k1 and b, that reaches the best value at 1e-6,
    and the table (k1, b, metric) of the whole grid, evaluated in one job."""
    runs = bm25_grid_runs(docs_or_index, queries, grid, k, tokenizer, epsilon)
    judged = qrels.join(bounded_broadcast(queries.select(id_str("query_id").alias("query_id")).distinct()), "query_id", "left_semi")
    table = evaluate_run(runs, judged, [metric], group_cols=["k1", "b"], groups=grid)
    table = table.withColumn(metric, round6(F.col(f"`{metric}`"))).checkpoint(eager=True)  # one row a setting
    best = table.orderBy(F.col(f"`{metric}`").desc(), "k1", "b").first()
    return best["k1"], best["b"], table


# ------------------------------------------------------------------------- multi-field

def bm25_fields(docs: DataFrame, queries: DataFrame, fields: dict[str, str], weights: dict[str, float],
                k: int = 10, tokenizer=None, k1: float = 1.2, b: float = 0.75, epsilon: float = 0.25) -> DataFrame:
    """Per-field BM25 (own df, N and avgdl per field), combined as a weighted sum.
    ``fields`` maps field name -> text column of ``docs``."""
    if k <= 0:
        return empty_run(queries.sparkSession)
    qterms = query_terms(queries, tokenizer)
    parts = []
    for name, col in fields.items():
        idx = build_index(docs.select("doc_id", F.col(col).alias("text")), tokenizer)
        m = bm25_matched(idx, qterms, k1, b, epsilon)
        parts.append(m.select("query_id", "doc_id", (F.col("contribution") * float(weights.get(name, 1.0))).alias("c")))
    allm = parts[0]
    for p in parts[1:]:
        allm = allm.unionByName(p)
    scores = allm.groupBy("query_id", "doc_id").agg(F.sum("c").alias("score"))
    return ranked_run(scores, k)


# ------------------------------------------------------------------ paragraph similarity

def _paragraph_vectors(paras: DataFrame, g: list[str], tokenizer, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(para, cls, grp, norm, t, tf): term numbers by falling document frequency, their counts and the norm of the
    weights.  Paragraphs of one group with the same term counts share ``cls``, a 256-bit digest of both.  With it
    the idf of the first term number of each document frequency."""
    src = paras.select(F.col(id_col).alias("doc_id"), "text", *[F.col(c).cast("string").alias("grp") for c in g])
    idx = build_index(src.select("doc_id", "text"), tokenizer)
    _, norms = tfidf_weights(idx)
    terms = (global_rank(idx.term_df.select("term", "df"), [], [F.col("df").desc(), "term"])
             .select("term", "df", (F.col("grank") - 1).cast("int").alias("t")).checkpoint(eager=True))
    steps = attach_scalars(terms.groupBy("df").agg(F.min("t").alias("t")), idx.stats.select("n_docs")).select("t", _smooth_idf().alias("idf"))
    w = idx.with_terms(terms.select("term", "t")).join(norms, "doc_id")
    v = w.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("t", F.col("tf").cast("int").alias("tf")))).alias("v"), F.max("dnorm").alias("norm"))
    v = (v.join(src.select("doc_id", "grp").filter(F.col("grp").isNotNull()), "doc_id") if g
         else v.withColumn("grp", F.lit("")))
    counts = F.array_join(F.transform("v", lambda x: F.concat_ws(":", x["t"].cast("string"), x["tf"].cast("string"))), " ")
    return v.select(F.col("doc_id").alias("para"), F.sha2(F.concat_ws("\n", "grp", counts), 256).alias("cls"),
                    "grp", "norm", F.col("v.t").alias("t"), F.col("v.tf").alias("tf")), steps


def similar_pairs(paras: DataFrame, k: int = 3, group_col: str | None = None,
                  scope: str = "within", tokenizer=None, id_col: str = "para_id") -> DataFrame:
    """Most similar paragraphs by TF-IDF cosine (scikit-learn weighting, L2 over the whole
    paragraph), exact top-k partners per paragraph; partners share a term at least.

    Paragraphs of equal term counts are one class, so copies are never paired with each other.  The classes
    are packed into blocks, and a task scores two blocks over all terms and gives the best partners of each
    class only (:mod:`irspark.operators.pairs`): no row per matching pair is written or shuffled.  All
    blocks of a group (``scope`` 'within') or of the table meet, so the work grows with the square of their
    classes, what a task holds does not.

    ``scope`` 'within' keeps pairs of the same ``group_col`` value, 'across' pairs of different
    values; a paragraph with a null group has no partner.  -> (para_a, para_b, score, rank)."""
    g = [group_col] if group_col else []
    within = scope == "within" or not g
    rows, steps = _paragraph_vectors(paras, g, tokenizer, id_col)
    rows = rows.checkpoint(eager=True)
    reps = (rows.groupBy("cls").agg(F.any_value(F.struct("grp", "norm", "t", "tf")).alias("v"), F.min("para").alias("name"), F.count(F.lit(1)).alias("n"))
            .select("cls", "name", "n", "v.*").withColumn("id", F.monotonically_increasing_id()).checkpoint(eager=True))
    members = rows.select("para", "cls").join(reps.select("cls", "id"), "cls").select("id", "para")
    own = reps.filter("n > 1").select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("score"))   # unit length
    scored = best_partners(reps.select((F.col("grp") if within else F.lit("")).alias("zone"), "grp", "id", "name", "norm", "t", "tf"),
                           steps, k + 1, not within, lambda s: top_k(s, ["a"], [round6("score").desc(), F.col("name_b")], k + 1, None))
    scored = scored.select("a", "b", "score")
    scored = scored.unionByName(own) if within else scored
    scored = scored.withColumn("score", round6("score"))
    first = top_k(members, ["id"], [F.col("para")], k + 1, None).select(F.col("id").alias("b"), F.col("para").alias("para_b"))
    best = top_k(scored.join(first, "b"), ["a"], [F.col("score").desc(), F.col("para_b")], k + 1, None)
    out = (best.select(F.col("a").alias("id"), "para_b", "score")
           .join(members.withColumnRenamed("para", "para_a"), "id").filter(F.col("para_a") != F.col("para_b")))
    return top_k(out.select("para_a", "para_b", "score"), ["para_a"], [F.col("score").desc(), F.col("para_b").asc()], k)
