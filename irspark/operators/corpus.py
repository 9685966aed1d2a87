"""Corpus analytics: frequency lists, Zipf and Heaps curves, bigram association,
characteristic words, stylometry.  All two-level aggregations over the in-row postings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import bounded_broadcast, id_str, literal_broadcast, require_columns, round6, text_or_empty
from ..functions.text import bigrams, first_positions, resolve_tokenizer, run_ends, run_lengths
from .common import attach_scalars, top_k
from .index import Index, piece_count, postings_from_terms, postings_from_tokens, term_arrays, tokenize
from .ranking import global_rank


def word_freq(postings: DataFrame, group_cols=()) -> DataFrame:
    """(group..., term, freq): collection frequency; map-side partial sums before the shuffle."""
    return postings.groupBy(*group_cols, "term").agg(F.sum("tf").alias("freq"))


def corpus_stats(index: Index) -> DataFrame:
    """#docs, #tokens, avg doc length, #types, avg token length, avg type length (one row)."""
    f = word_freq(index.postings).withColumn("len", F.length("term"))
    v = f.agg(F.count(F.lit(1)).alias("n_types"), F.sum("freq").alias("n_tok_v"),
              F.try_divide(F.sum(F.col("freq") * F.col("len")).cast("double"), F.sum("freq")).alias("avg_token_len"),
              F.avg("len").alias("avg_type_len"))
    s = index.stats.select("n_docs", F.col("total_len").alias("n_tokens"), F.col("avgdl").alias("avg_doc_len"))
    return attach_scalars(s, v).drop("n_tok_v")


def token_freq(tokens: DataFrame, group_cols=(), tokens_col: str = "tokens", count_col: str | None = None) -> DataFrame:
    """(group..., term, freq) of all tokens, or of each row's tokens ``count_col`` times.  Only the collection counts
    are asked for, so the tokens of a row are neither sorted nor counted by row; partial sums before the shuffle."""
    one = F.lit(1) if count_col is None else F.col(count_col)
    # of ``explode`` Spark would infer a filter that makes the tokens a second time
    e = tokens.select(*group_cols, one.cast("bigint").alias("_n"), F.explode_outer(tokens_col).alias("term")).where("term IS NOT NULL")
    return e.groupBy(*group_cols, "term").agg(F.sum("_n").alias("freq"))


def corpus_stats_by(tokens: DataFrame, group: str = "variant", id_col: str = "doc_id", tokens_col: str = "tokens",
                    count_col: str | None = None, docs: DataFrame | None = None) -> DataFrame:
    """Same six statistics per value of ``group`` (collection variant, source, ...).

    Where the groups are made from terms alone, ``tokens`` may be rows of the vocabulary, whose tokens count
    ``count_col`` times; the documents of each group are then the rows of ``docs``."""
    f = token_freq(tokens, [group], tokens_col, count_col).withColumn("len", F.length("term"))
    v = f.groupBy(group).agg(F.count(F.lit(1)).alias("n_types"), F.sum("freq").alias("n_tokens"),
                             F.try_divide(F.sum(F.col("freq") * F.col("len")).cast("double"), F.sum("freq")).alias("avg_token_len"),
                             F.avg("len").alias("avg_type_len"))
    # rows are counted without their tokens; the number of tokens is the sum of the frequencies
    d = (tokens if docs is None else docs).groupBy(group).agg(F.count(F.lit(1)).alias("n_docs"))
    d = d.join(v, group, "left").withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0).cast("bigint")))
    d = d.withColumn("avg_doc_len", F.try_divide(F.col("n_tokens").cast("double"), F.col("n_docs")))
    return d.select(group, "n_docs", "n_tokens", "avg_doc_len", "n_types", "avg_token_len", "avg_type_len")


def _words_df(spark, words) -> DataFrame:
    if isinstance(words, DataFrame):
        return words.select(F.col(words.columns[0]).alias("term")).distinct()
    return spark.createDataFrame([(w,) for w in sorted(set(words))], "term string")


def stopword_mass(freq: DataFrame, stopwords) -> DataFrame:
    """Occurrences of stop words and their share of all tokens."""
    sw = literal_broadcast(_words_df(freq.sparkSession, stopwords)) if not isinstance(stopwords, DataFrame) \
        else bounded_broadcast(_words_df(freq.sparkSession, stopwords))
    flagged = freq.join(sw.withColumn("_sw", F.lit(1)), "term", "left")
    return flagged.agg(F.sum(F.when(F.col("_sw") == 1, F.col("freq")).otherwise(0)).alias("stop_tokens"),
                       F.sum("freq").alias("all_tokens"),
                       F.countDistinct(F.when(F.col("_sw") == 1, F.col("term"))).alias("stop_types_found")) \
        .withColumn("stop_share", F.try_divide(F.col("stop_tokens").cast("double"), F.col("all_tokens")))


def top_terms(freq: DataFrame, n: int) -> DataFrame:
    """Top-n of the frequency list (count desc, term asc): a TakeOrdered, n rows."""
    return freq.orderBy(F.col("freq").desc(), F.col("term").asc()).limit(n)


def top_non_stopwords(freq: DataFrame, stopwords, n: int = 30) -> DataFrame:
    """Which of the top-n terms are not stop words (candidates to add to the list)."""
    sw = literal_broadcast(_words_df(freq.sparkSession, stopwords))
    top = top_terms(freq, n)
    w = Window.orderBy(F.col("freq").desc(), F.col("term").asc())  # over n rows only
    return top.withColumn("rank", F.row_number().over(w)).join(sw, "term", "left_anti")


def zipf(freq: DataFrame) -> DataFrame:
    """One row per distinct frequency: terms at it, first/last rank, log10s, and the fitted
    log-log line.  Ranks come from a prefix sum over the frequency-of-frequency table, which
    has at most a few thousand rows, never from a window over the vocabulary."""
    ff = freq.groupBy("freq").agg(F.count(F.lit(1)).alias("n_terms"))
    w = Window.orderBy(F.col("freq").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ff = ff.withColumn("first_rank", F.coalesce(F.sum("n_terms").over(w), F.lit(0)) + 1)
    ff = ff.withColumn("last_rank", F.col("first_rank") + F.col("n_terms") - 1)
    ff = ff.withColumn("log_rank", F.log10("first_rank")).withColumn("log_freq", F.log10("freq"))
    fit = ff.agg(F.regr_slope("log_freq", "log_rank").alias("slope"),
                 F.regr_intercept("log_freq", "log_rank").alias("intercept"))
    return attach_scalars(ff, fit)


def doc_offsets(doc_len: DataFrame, order_col: str, group_cols=()) -> DataFrame:
    """Token offset of each document in (group, order) order: distributed prefix sum."""
    r = global_rank(doc_len, group_cols, [order_col], "_r")
    # prefix of lengths: within-partition running sums would need a window per group; use
    # the same blocking trick on the length column.
    g = list(group_cols)
    blocks = r.withColumn("_b", F.floor((F.col("_r") - 1) / F.lit(4096)))
    bsum = blocks.groupBy(*g, "_b").agg(F.sum("dl").alias("_bs"))
    wb = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bsum = bsum.withColumn("_boff", F.coalesce(F.sum("_bs").over(wb), F.lit(0)))
    wi = Window.partitionBy(*g, "_b").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    within = blocks.withColumn("_ioff", F.coalesce(F.sum("dl").over(wi), F.lit(0)))
    return (within.join(bsum.select(*g, "_b", "_boff"), [*g, "_b"])
            .withColumn("offset", F.col("_boff") + F.col("_ioff")).drop("_b", "_boff", "_ioff", "_r"))


def heaps(tokens: DataFrame, order_col: str, checkpoints: list[int], group_cols=(),
          id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """Vocabulary size after n tokens, at each checkpoint n (documents in ``order_col``
    order, tokens in text order).  A term enters at its first global position; counts per
    checkpoint bucket are summed cumulatively over the (few) checkpoints."""
    return heaps_by_orders(tokens, [order_col], checkpoints, group_cols, id_col, tokens_col)[0]


def heaps_by_orders(tokens: DataFrame, order_cols: list[str], checkpoints: list[int], group_cols=(),
                    id_col: str = "doc_id", tokens_col: str = "tokens") -> list[DataFrame]:
    """``heaps`` for several orders of the same documents.  The texts are read once, and the terms of a
    document come out once, with its offsets in all orders."""
    g = list(group_cols)
    cps = sorted({int(c) for c in checkpoints if int(c) > 0})
    # one pass over the texts: length and first position of each term inside its document
    # (computed in the document row: no token explode, no (doc, term) shuffle); checkpointed
    # so lengths, totals and positions do not tokenise again
    per_doc = tokens.select(id_col, *order_cols, *g, F.size(tokens_col).alias("dl"),
                            first_positions(tokens_col).alias("fp")).checkpoint(eager=True)
    dl = per_doc.select(id_col, *order_cols, *g, "dl")
    off = None
    for i, order_col in enumerate(order_cols):
        mine = doc_offsets(dl, order_col, g).select(id_col, *g, F.col("offset").alias(f"_o{i}"))
        off = mine if off is None else off.join(mine, [id_col, *g])
    # documents meet their offsets as one row each; their terms come out only then
    pos = per_doc.select(id_col, *g, "fp").join(bounded_broadcast(off, checkpoint=True), [id_col, *g])
    offsets = [f"_o{i}" for i in range(len(order_cols))]
    first = (pos.select(*g, *offsets, F.inline("fp"))
             .groupBy(*g, "term").agg(*[F.min(F.col(o) + F.col("pos")).alias(o) for o in offsets]))
    first = first.checkpoint(eager=True) if len(offsets) > 1 else first
    return [_heaps_curve(tokens, dl, first.select(*g, F.col(o).alias("first_pos")), cps, g) for o in offsets]


def _heaps_curve(tokens: DataFrame, dl: DataFrame, first: DataFrame, cps: list[int], g: list[str]) -> DataFrame:
    """The curve of each group from the first position of each of its terms."""
    arr = F.array(*[F.lit(c) for c in cps])
    # bucket = index of the first checkpoint c with first_pos < c
    first = first.withColumn("bucket", F.size(F.filter(arr, lambda c: c <= F.col("first_pos"))))
    cnt = first.groupBy(*g, "bucket").agg(F.count(F.lit(1)).alias("new_types"))
    grid = tokens.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cps)], "bucket int, n_tokens long")
    groups = tokens.select(*g).distinct() if g else None
    base = groups.crossJoin(F.broadcast(grid)) if g else grid
    tot = dl.groupBy(*g).agg(F.sum("dl").alias("total"))
    base = (base.join(tot, g) if g else attach_scalars(base, tot)).filter(F.col("n_tokens") <= F.col("total"))
    w = Window.partitionBy(*g).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    out = (base.join(cnt, [*g, "bucket"], "left").withColumn("new_types", F.coalesce("new_types", F.lit(0)))
           .withColumn("n_types", F.sum("new_types").over(w)))
    out = out.withColumn("log_tokens", F.log10("n_tokens")).withColumn("log_types", F.log10("n_types"))
    fit = out.groupBy(*g).agg(F.regr_slope("log_types", "log_tokens").alias("heaps_beta"))
    out = out.join(fit, g) if g else attach_scalars(out, fit)
    return out.select(*g, "n_tokens", "n_types", "log_tokens", "log_types", "heaps_beta")


def bigram_freq(tokens: DataFrame, tokens_col: str = "tokens", group_cols=()) -> DataFrame:
    """(group..., bigram, freq): adjacent pairs counted per document first, so that a frequent pair sends a row a
    document at most.  Tasks grow in number with the input files, not in what they hold."""
    n = piece_count(tokens)
    rows = tokens.select(*group_cols, tokens_col)
    rows = rows.repartition(n) if rows.rdd.getNumPartitions() < n else rows
    rows = rows.select(*group_cols, F.sort_array(bigrams(tokens_col)).alias("_s")).select(*group_cols, run_ends("_s").alias("_e"))
    rows = rows.select(*group_cols, F.inline(run_lengths("_e"))).withColumnRenamed("term", "bigram")
    return rows.repartition(n, *group_cols, "bigram").groupBy(*group_cols, "bigram").agg(F.sum("tf").alias("freq"))


def bigram_assoc(big: DataFrame, uni: DataFrame, min_count: int = 5, stopwords=None) -> DataFrame:
    """Dictionary-worthy bigrams: PMI and t-score from bigram and unigram counts.
    N = number of tokens; PMI = log2(c12 N / (c1 c2)); t = (c12 - c1 c2 / N) / sqrt(c12)."""
    n = uni.agg(F.sum("freq").alias("n"))
    b = big.filter(F.col("freq") >= min_count).withColumn("w1", F.split("bigram", " ").getItem(0)) \
        .withColumn("w2", F.split("bigram", " ").getItem(1))
    if stopwords:
        sw = [w for w in stopwords]
        b = b.filter(~F.col("w1").isin(sw) & ~F.col("w2").isin(sw))
    u1 = uni.select(F.col("term").alias("w1"), F.col("freq").alias("c1"))
    u2 = uni.select(F.col("term").alias("w2"), F.col("freq").alias("c2"))
    j = attach_scalars(b.join(u1, "w1").join(u2, "w2"), n)
    c12, c1, c2, N = (F.col(x).cast("double") for x in ("freq", "c1", "c2", "n"))
    return j.select("bigram", "w1", "w2", "freq", "c1", "c2",
                    F.log2(c12 * N / (c1 * c2)).alias("pmi"),
                    ((c12 - c1 * c2 / N) / F.sqrt(c12)).alias("t_score"))


def characteristic_words(freq_by_group: DataFrame, group: str, k: int = 20) -> DataFrame:
    """Log-odds ratio with an informative Dirichlet prior (the pooled counts), z-scored,
    each group against all the others; top-k words per group."""
    f = freq_by_group.checkpoint(eager=True)   # read four times; the texts behind it are counted once
    tot = f.groupBy("term").agg(F.sum("freq").alias("a_w"))
    a0 = tot.agg(F.sum("a_w").alias("a0"))
    ng = f.groupBy(group).agg(F.sum("freq").alias("n_g"))
    j = attach_scalars(f.join(tot, "term").join(bounded_broadcast(ng), group), a0)
    y, aw, a0c, n = (F.col(x).cast("double") for x in ("freq", "a_w", "a0", "n_g"))
    yo, no = aw - y, a0c - n  # the rest of the corpus
    d = (F.log((y + aw) / (n + a0c - y - aw)) - F.log((yo + aw) / (no + a0c - yo - aw)))
    var = 1.0 / (y + aw) + 1.0 / (yo + aw)
    s = j.select(group, "term", "freq", (d / F.sqrt(var)).alias("z"))
    return top_k(s, [group], [F.col("z").desc(), F.col("term").asc()], k)


def stylometry(tokens: DataFrame, stopwords, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """Per document, computed in-row: type/token ratio, mean word length, stop-word share,
    hapax share (of types), repeated-bigram share (of bigram tokens)."""
    sw = F.array(*[F.lit(w) for w in sorted(set(stopwords))])
    # one row all the way: counts of words and of bigrams side by side, step by step (see term_arrays)
    t = tokens.select(id_col, tokens_col, F.size(tokens_col).cast("bigint").alias("dl"), F.sort_array(tokens_col).alias("_s"),
                      F.sort_array(bigrams(tokens_col)).alias("_b"))
    t = t.select(id_col, tokens_col, "dl", F.size("_b").cast("bigint").alias("n_bigrams"), run_ends("_s").alias("_e"), run_ends("_b").alias("_be"))
    t = t.select(id_col, tokens_col, "dl", "n_bigrams", run_lengths("_e").alias("tc"), run_lengths("_be").alias("btc"))
    n = F.col("dl").cast("double")
    return t.select(
        id_col,
        F.col("dl").alias("n_tokens"),
        F.size("tc").alias("n_types"),
        F.try_divide(F.size("tc").cast("double"), n).alias("ttr"),
        F.try_divide(F.aggregate(tokens_col, F.lit(0).cast("bigint"), lambda acc, x: acc + F.length(x)).cast("double"), n).alias("mean_word_len"),
        F.try_divide(F.size(F.filter(tokens_col, lambda x: F.array_contains(sw, x))).cast("double"), n).alias("stop_share"),
        F.try_divide(F.size(F.filter("tc", lambda x: x["tf"] == 1)).cast("double"), F.size("tc").cast("double")).alias("hapax_share"),
        F.try_divide(F.aggregate(F.filter("btc", lambda x: x["tf"] > 1), F.lit(0).cast("bigint"), lambda acc, x: acc + x["tf"]).cast("double"),
                     F.col("n_bigrams").cast("double")).alias("repeated_bigram_share"),
    )
