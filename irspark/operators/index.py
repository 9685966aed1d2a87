"""Inverted index as plain DataFrames.

``postings(doc_id, term, tf, dl)`` is built map-side: term counts are computed inside each
document row (:func:`irspark.functions.text.term_counts`), so building the index needs no
shuffle.  Document frequency is one ``groupBy(term)`` with map-side partial counts, so a
term that occurs in every document costs one row per map task, not one per document.
Corpus scalars (N, total length, avgdl) are a one-row frame joined by broadcast.

A second copy of the postings is clustered by term, written when a query batch first asks for a small
share of them.  Such batches read the files and row groups of their terms only.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from dataclasses import dataclass
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import fits_broadcast, id_str, require_columns, text_or_empty
from ..functions.text import MOST_FORMS, least_count, resolve_tokenizer, run_ends, run_lengths
from .common import arrow_batches


BUCKET_BYTES = 256 << 20   # input bytes per bucket of the forward index
PIECE_BYTES = 16 << 20     # input bytes per task where a task holds what it counts
CHUNK_POSTINGS = 4 << 20   # postings per file of the copy clustered by term
TEXT_BYTES = 8 << 20       # texts that a Python worker is sent at once
ROW_GROUP_BYTES = 8 << 20  # and bytes of its row groups, whose statistics say which terms they hold
MAX_LOOKUP_TERMS = 1 << 16  # terms of a query batch that the driver looks up in the file bounds
HOT_TERMS = 1024           # a term with more than one in so many postings is joined by broadcast
MAX_INTERVALS = 64         # term intervals of one pushed filter

# Which copy of the postings a query batch reads: 'documents' (the forward index), 'terms' (the copy
# clustered by term), or 'auto': by term when the batch asks for at most LOOKUP_SHARE of all postings.
LAYOUT_CONF = "irspark.postings.layout"
LOOKUP_SHARE = 0.25


@dataclass
class Index:
    postings: DataFrame   # doc_id STRING, term STRING, tf BIGINT, dl BIGINT
    doc_len: DataFrame    # doc_id STRING, dl BIGINT  (every document, empty ones included)
    term_df: DataFrame    # term STRING, df BIGINT
    stats: DataFrame      # one row: n_docs, total_len, avgdl, n_terms, mean_okapi_idf, n_postings
    path: str | None = None  # where the index is written (None for a lazy index)
    rows: DataFrame | None = None  # the written forward index: doc_id, dl, tc array<struct<term, tf>>
    copied: bool = True   # whether a batch may write the copy clustered by term; an index asked once only reads one

    def derived(self, name: str, build) -> DataFrame:
        """A per-corpus table derived from this index (e.g. TF-IDF document norms), written
        next to the index the first time and read back afterwards."""
        if self.path is None:
            return build(self)
        spark = self.postings.sparkSession
        nb = self.stats.select("n_buckets").first()["n_buckets"] if "n_buckets" in self.stats.columns else None
        # the layout (bucket count) is part of the folder name, so a folder is only ever read
        # with the layout it was written with
        target = f"{self.path}/derived_{name}_b{nb or 0}"
        tname = _table_name(target)
        try:
            if nb and spark.catalog.tableExists(tname):
                return spark.table(tname)
            t = spark.read.parquet(target)
            if nb and "doc_id" in t.columns:
                return _register_bucketed(spark, target, tname, int(nb))
            return t
        except AnalysisException:
            df = build(self)
            if nb and "doc_id" in df.columns:
                # bucketed like the forward index: joins on doc_id with postings-derived
                # frames are co-partitioned (no shuffle on either side)
                (df.repartition(int(nb), "doc_id").write.mode("overwrite").bucketBy(int(nb), "doc_id")
                 .option("path", target).saveAsTable(tname))
                return spark.table(tname)
            df.write.mode("overwrite").parquet(target)
            return spark.read.parquet(target)


    def with_terms(self, table: DataFrame, postings: DataFrame | None = None) -> DataFrame:
        """Postings (or other rows with a ``term``) joined with a table of the vocabulary on ``term``.

        A table within the broadcast bounds is broadcast.  Beyond them the most frequent terms, as many as a
        broadcast takes (see ``least_count``) and any that holds more than one in HOT_TERMS of all postings, are
        joined by broadcast.  Only the postings of all others, the rare ones, are shuffled."""
        rows = self.postings if postings is None else postings
        if fits_broadcast(table):
            return rows.join(F.broadcast(table), "term")
        least = least_count(self.term_df.select(F.col("term").alias("_t"), F.col("df").alias("_n")))
        hot = (self.term_df.crossJoin(F.broadcast(self.stats.select("n_postings")))
               .where((F.col("df") >= least) | (F.col("df") * HOT_TERMS > F.col("n_postings"))).select("term").checkpoint(eager=True))
        hot = F.broadcast(hot)
        few = table.join(hot, "term", "left_semi").checkpoint(eager=True)
        return (rows.join(F.broadcast(few), "term")
                .unionByName(rows.join(hot, "term", "left_anti").join(table.join(hot, "term", "left_anti").hint("shuffle_merge"), "term")))

    def mapped(self, mapping: DataFrame, term_col: str = "term", mapped_col: str = "mapped") -> "Index":
        """The index of the same documents with every term replaced by its mapped form (stem, lemma); terms
        without one stay.  Each distinct term is mapped once, and postings that become equal are added up; no
        token occurrence is moved, and with a mapping within the broadcast bounds no posting either."""
        table = (self.term_df.select("term")
                 .join(mapping.select(F.col(term_col).alias("term"), F.col(mapped_col).alias("_m")).dropDuplicates(["term"]), "term", "left")
                 .select("term", F.coalesce("_m", "term").alias("_m")).checkpoint(eager=True))
        postings = (self.with_terms(table).groupBy("doc_id", F.col("_m").alias("term"))
                    .agg(F.sum("tf").alias("tf"), F.max("dl").alias("dl")).select("doc_id", "term", "tf", "dl"))
        return _derive(postings, self.doc_len)

    def by_term(self) -> tuple[DataFrame, list]:
        """(term, doc_id, tf, dl, chunk) sorted by term, one file a chunk, and (chunk, first, last) of each
        file in that order.  Written next to the index the first time.  A frequent term goes over as many
        files as its postings fill.  The list of files is written last and marks a complete copy."""
        spark, target = self.postings.sparkSession, f"{self.path}/by_term"
        try:
            files = spark.read.parquet(f"{target}_files")
        except AnalysisException:
            n = self.stats.select("n_postings").first()["n_postings"] or 0
            chunks = max(spark.sparkContext.defaultParallelism, -(-n // CHUNK_POSTINGS))
            (self.postings.repartitionByRange(chunks, "term", "doc_id").withColumn("chunk", F.spark_partition_id())
             .sortWithinPartitions("chunk", "term", "doc_id").select("term", "doc_id", "tf", "dl", "chunk")
             .write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("chunk").parquet(target))
            (spark.read.schema(BY_TERM).parquet(target).groupBy("chunk").agg(F.min("term").alias("first"), F.max("term").alias("last"))
             .coalesce(1).write.mode("overwrite").parquet(f"{target}_files"))
            files = spark.read.parquet(f"{target}_files")
        bounds = sorted((r["first"], r["last"], r["chunk"]) for r in files.collect())   # one row per file
        return spark.read.schema(BY_TERM).parquet(target), [(c, first, last) for first, last, c in bounds]

    def _has_copy(self) -> bool:
        try:
            return bool(self.postings.sparkSession.read.parquet(f"{self.path}/by_term_files").columns)
        except AnalysisException:
            return False

    def lookup(self, terms: DataFrame) -> DataFrame | None:
        """The part of the copy clustered by term that can hold ``terms``: partition filters choose the
        files, pushed filters their row groups.  None when the batch asks for too much of the index."""
        layout = self.postings.sparkSession.conf.get(LAYOUT_CONF, "auto")
        if self.path is None or layout == "documents" or (layout != "terms" and not self.copied and not self._has_copy()):
            return None
        terms = terms.select("term").distinct()
        found = (self.term_df.join(terms, "term").select("term", "df").limit(MAX_LOOKUP_TERMS + 1).collect())
        if len(found) > MAX_LOOKUP_TERMS:
            return None
        asked, there = sum(r["df"] for r in found), self.stats.select("n_postings").first()["n_postings"] or 0
        if layout != "terms" and asked > LOOKUP_SHARE * there:
            return None
        if not found:
            return self.postings.where(F.lit(False))
        table, files = self.by_term()
        wanted = sorted(r["term"] for r in found)
        return table.where(_term_filter(wanted, files)).drop("chunk")

    def matching(self, side: DataFrame, docs: DataFrame | None = None) -> DataFrame:
        """Postings joined on ``term`` with the rows of a query side (checkpointed by the caller), from
        whichever copy of the postings the batch reads less of; of the documents ``docs`` only if given."""
        return self.joined(self.lookup(side), side, docs)

    def joined(self, some: DataFrame | None, side: DataFrame, docs: DataFrame | None = None) -> DataFrame:
        """``matching`` with what ``lookup`` has given for ``side``."""
        some = self.postings if some is None else some
        return (some if docs is None else some.join(docs, "doc_id", "left_semi")).join(side, "term")


BY_TERM = "term string, doc_id string, tf bigint, dl bigint, chunk int"


def _term_filter(wanted: list[str], files: list):
    """Files and term intervals that hold the sorted terms.  Neighbouring terms share an interval when
    there are more than MAX_INTERVALS; what it holds besides them the join drops."""
    chunks, at = [], 0
    for chunk, first, last in files:                      # both lists ascend
        while at < len(wanted) and wanted[at] < first:
            at += 1
        if at < len(wanted) and wanted[at] <= last:
            chunks.append(chunk)
    if not chunks:
        return F.lit(False)
    step = -(-len(wanted) // MAX_INTERVALS)
    inside = F.lit(False)
    for i in range(0, len(wanted), step):
        low, high = wanted[i], wanted[min(i + step, len(wanted)) - 1]
        inside = inside | ((F.col("term") == low) if low == high else F.col("term").between(low, high))
    return F.col("chunk").isin(chunks) & inside


def _table_name(path: str) -> str:
    return "irspark_doc_terms_" + hashlib.sha1(path.encode("utf-8")).hexdigest()[:16]


def _register_bucketed(spark, location: str, name: str, n_buckets: int):
    if not spark.catalog.tableExists(name):
        schema = spark.read.parquet(location).schema
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY (doc_id) INTO {int(n_buckets)} BUCKETS "
                  f"LOCATION '{location}'")
    return spark.table(name)


def _doc_terms(spark, path: str, n_buckets: int | None):
    """The forward index as a table bucketed by doc_id (so joins and (query, doc) sums keep
    the doc partitioning); registered in this session's catalog on first use."""
    if n_buckets:
        return _register_bucketed(spark, f"{path}/doc_terms", _table_name(path), int(n_buckets))
    return spark.read.parquet(f"{path}/doc_terms")


def load_index(spark, path: str) -> Index:
    stats = spark.read.parquet(f"{path}/stats")
    nb = stats.select("n_buckets").first()["n_buckets"] if "n_buckets" in stats.columns else None
    t = _doc_terms(spark, path, nb)
    return Index(
        postings=postings_from_terms(t),
        doc_len=t.select("doc_id", "dl"),
        term_df=spark.read.parquet(f"{path}/term_df"),
        stats=stats,
        path=path,
        rows=t,
    )


def tokenize(df: DataFrame, id_col: str, text_col: str = "text", tokenizer=None,
             out: str = "tokens") -> DataFrame:
    tok = resolve_tokenizer(tokenizer)
    return df.select(id_str(id_col).alias(id_col), tok(text_or_empty(text_col)).alias(out))


def term_arrays(tokens: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, tokens array) -> (id, dl, tc array<struct<term, tf>>): a forward index row per
    document.  Term counts are computed inside each row: sort, find run ends, difference.
    The steps are separate projections so each intermediate array is computed once."""
    return (
        tokens.select(id_col, *keep, F.size(tokens_col).cast("bigint").alias("dl"),
                      F.sort_array(tokens_col).alias("_s"))
        .select(id_col, *keep, "dl", run_ends("_s").alias("_e"))
        .select(id_col, *keep, "dl", run_lengths("_e").alias("tc"))
    )


TERM_ARRAYS = "`{}` string, dl bigint, tc array<struct<term:string,tf:bigint>>"
SLICE_CHARS = 4 << 20      # bytes of text whose counts a worker holds before it passes them on


def _count_terms(counts):
    """Rows (id, text) -> (id, dl, tc) as ``term_arrays`` gives them, terms by first place; ``counts`` gives the
    tokens of a text."""
    import pyarrow as pa

    def packed(ids, dls, sizes, terms, tfs):
        offsets = pa.array([0, *accumulate(sizes)], pa.int32())
        pairs = pa.StructArray.from_arrays([pa.array(terms, pa.string()), pa.array(tfs, pa.int64())], ["term", "tf"])
        return pa.RecordBatch.from_arrays([ids, pa.array(dls, pa.int64()), pa.ListArray.from_arrays(offsets, pairs)], ["id", "dl", "tc"])

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            first, size, found = 0, 0, ([], [], [], [])
            for i, text in enumerate(texts):
                text = text.as_py() or b""
                c = counts(text.decode("utf-8", "replace"))
                names = list(c)
                found[0].append(sum(c.values()))
                found[1].append(len(names))
                found[2].extend(names)
                found[3].extend(map(c.__getitem__, names))
                size += len(text)
                if size > SLICE_CHARS:
                    yield packed(batch.column(0).slice(first, i + 1 - first), *found)
                    first, size, found = i + 1, 0, ([], [], [], [])
            if first < batch.num_rows:
                yield packed(batch.column(0).slice(first), *found)
    return run


def _map_terms(rule):
    """Rows (id, dl, tc) with every term replaced by its form; terms of a row that become equal are added up."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        forms = {}
        for batch in batches:
            tc, n = batch.column(2), batch.num_rows
            flat = tc.flatten()
            words = flat.field(0).dictionary_encode()
            if len(forms) > MOST_FORMS:
                forms.clear()
            known = words.dictionary.to_pylist()
            forms.update((w, rule(w)) for w in known if w not in forms)
            mapped = pa.array([forms[w] for w in known], pa.string()).dictionary_encode()
            size = max(1, len(mapped.dictionary))
            row = np.repeat(np.arange(n), tc.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            key = row * size + mapped.indices.to_numpy(zero_copy_only=False)[words.indices.to_numpy(zero_copy_only=False)]
            order = np.argsort(key, kind="stable")
            key, tf = key[order], flat.field(1).to_numpy(zero_copy_only=False)[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            tf = np.add.reduceat(tf, first) if len(key) else tf
            key = key[first]
            offsets = np.concatenate([[0], np.cumsum(np.bincount(key // size, minlength=n))]).astype(np.int32)
            pairs = pa.StructArray.from_arrays([mapped.dictionary.take(pa.array(key % size)), pa.array(tf, pa.int64())], ["term", "tf"])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(offsets), pairs)], ["id", "dl", "tc"])
    return run


def counted_terms(docs: DataFrame, id_col: str, text_col: str, tokenizer) -> DataFrame | None:
    """``term_arrays`` of the texts by a tokenizer that counts in the Python workers; None for any other."""
    counts = getattr(resolve_tokenizer(tokenizer), "_irspark_counts", None)
    if counts is None:
        return None
    texts = docs.select(id_str(id_col).alias(id_col), text_or_empty(text_col).alias("text"))
    return texts.mapInArrow(_count_terms(counts), TERM_ARRAYS.format(id_col))


def postings_from_terms(terms: DataFrame, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    return terms.select(id_col, *keep, "dl", F.inline("tc")).select(id_col, *keep, "term", "tf", "dl")


def postings_from_tokens(tokens: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens",
                         keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, tokens array) -> (id, term, tf, dl) without a shuffle."""
    return postings_from_terms(term_arrays(tokens, id_col, tokens_col, keep), id_col, keep)


def tokenizer_key(tokenizer) -> str | None:
    """A stable name for a tokenizer, or None when it has none (lambdas, closures without
    an ``_irspark_key``): such indexes are never reused."""
    tok = resolve_tokenizer(tokenizer)
    key = getattr(tok, "_irspark_key", None)
    if key:
        return str(key)
    qn = getattr(tok, "__qualname__", "")
    if not qn or "<lambda>" in qn or "<locals>" in qn:
        return None
    return f"{getattr(tok, '__module__', '')}.{qn}"


def input_files(docs: DataFrame) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of every input file, from the file system's own listing."""
    jvm, conf = docs.sparkSession._jvm, docs.sparkSession._jsparkSession.sessionState().newHadoopConf()
    out = []
    for name in sorted(docs.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        status = path.getFileSystem(conf).getFileStatus(path)
        out.append((name, status.getLen(), status.getModificationTime()))
    return out


def bucket_count(docs: DataFrame) -> int:
    """Buckets of about BUCKET_BYTES of input, but one per core and shuffle partition at least."""
    spark = docs.sparkSession
    size = sum(n for _, n, _ in input_files(docs))
    return max(-(-size // BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism)


def piece_count(df: DataFrame) -> int:
    """Tasks that read about PIECE_BYTES of input files each, but one per core at least."""
    size = sum(n for _, n, _ in input_files(df))
    return max(-(-size // PIECE_BYTES), df.sparkSession.sparkContext.defaultParallelism)


def index_key(docs: DataFrame, tokenizer, id_col: str, text_col: str) -> str | None:
    """Reuse key: the documents' logical plan (``semanticHash``), their input files (name,
    length and modification time, so rewritten files give a new index) and the tokenizer."""
    tk = tokenizer_key(tokenizer)
    files = input_files(docs)
    if tk is None or not files:  # in-memory frames have no stable identity: never reused
        return None
    files = ",".join(map(str, files))
    # bump the version whenever the on-disk layout changes: stale layouts are never reused
    raw = f"v6|{docs.semanticHash()}|{files}|{tk}|{id_col}|{text_col}"
    return hashlib.sha1(raw.encode("utf-8")).hexdigest()[:24]


def _try_load(spark, path: str) -> Index | None:
    try:
        return load_index(spark, path)
    except AnalysisException:
        return None


def build_index(docs: DataFrame, tokenizer=None, id_col: str = "doc_id", text_col: str = "text",
                materialize: bool = True, path: str | None = None, reuse: bool = True,
                num_buckets: int | None = None) -> Index:
    """Tokenise once and derive postings, lengths, document frequencies and corpus stats.

    With ``materialize`` (default) the per-document term arrays are written once as parquet
    under the shared checkpoint folder (``spark.checkpoint.dir``); postings and lengths are
    map-side views over that table, and df / corpus stats are written next to it.  So the
    documents are scanned and tokenised exactly once, later joins read the written index, and
    lineage is cut (a lost executor never re-runs the tokenizer).

    The forward index is written as a table bucketed by ``doc_id`` (``num_buckets``, default
    about one per 256 MB of input, see ``bucket_count``).

    With ``reuse`` an index already written for the same documents and tokenizer (same
    logical plan, input files and tokenizer name) is read back instead of rebuilt -- build
    once, query many times.  ``materialize=False`` keeps everything lazy.
    """
    require_columns(docs, {id_col, text_col}, "docs")
    spark = docs.sparkSession
    if materialize and path is None and reuse:
        key = index_key(docs, tokenizer, id_col, text_col)
        if key is not None:
            path = os.path.join(spark.conf.get("spark.checkpoint.dir"), "irspark-indexes", key)
            found = _try_load(spark, path)
            if found is not None:
                return found
    if not materialize:
        terms = term_arrays(tokenize(docs, id_col, text_col, tokenizer), id_col).withColumnRenamed(id_col, "doc_id")
        return _derive(postings_from_terms(terms), terms.select("doc_id", "dl"))
    if path is None:
        path = os.path.join(spark.conf.get("spark.checkpoint.dir"), "irspark-indexes", uuid.uuid4().hex)
    nb = int(num_buckets or bucket_count(docs))
    base = getattr(resolve_tokenizer(tokenizer), "_irspark_base", None)
    if base is not None and reuse and index_key(docs, base[0], id_col, text_col):
        # the texts are read and counted once for all rules on the terms of one tokenizer; its files hold whole buckets
        terms = build_index(docs, base[0], id_col, text_col).rows.mapInArrow(_map_terms(base[1]), TERM_ARRAYS.format("doc_id"))
    else:
        terms = counted_terms(docs, id_col, text_col, tokenizer)
        if terms is None:
            terms = term_arrays(tokenize(docs, id_col, text_col, tokenizer), id_col)
        terms = terms.withColumnRenamed(id_col, "doc_id").repartition(nb, "doc_id")
    # one shuffle at build time (rows of the forward index to their doc_id bucket, one file
    # per bucket) so that no query pays a (query, doc) aggregation shuffle later
    name = _table_name(path)
    with arrow_batches(spark, TEXT_BYTES):
        terms.write.mode("overwrite").bucketBy(nb, "doc_id").option("path", f"{path}/doc_terms").saveAsTable(name)
    t = spark.table(name)
    idx = _derive(postings_from_terms(t), t.select("doc_id", "dl"))
    idx.term_df.write.mode("overwrite").parquet(f"{path}/term_df")
    idx = _derive(idx.postings, idx.doc_len, spark.read.parquet(f"{path}/term_df"))
    # stats last: its presence marks a complete index for reuse
    idx.stats.withColumn("n_buckets", F.lit(nb)).write.mode("overwrite").parquet(f"{path}/stats")
    return load_index(spark, path)


def _derive(postings: DataFrame, doc_len: DataFrame, term_df: DataFrame | None = None) -> Index:
    if term_df is None:
        term_df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    base = (doc_len.agg(F.count(F.lit(1)).alias("n_docs"),
                        F.coalesce(F.sum("dl"), F.lit(0)).cast("bigint").alias("total_len"))
            .withColumn("avgdl", F.try_divide(F.col("total_len").cast("double"), F.col("n_docs"))))
    # vocabulary-wide scalars that scorers need (Okapi idf floor uses the mean raw idf)
    raw_idf = F.ln(F.col("n_docs") - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)
    vocab = (term_df.crossJoin(F.broadcast(base.select("n_docs")))
             .agg(F.count(F.lit(1)).alias("n_terms"), F.avg(raw_idf).alias("mean_okapi_idf"), F.sum("df").alias("n_postings")))
    stats = base.crossJoin(F.broadcast(vocab))  # one row x one row
    return Index(postings, doc_len, term_df, stats)


def term_stats(index: Index) -> DataFrame:
    """Per term: df, collection frequency, plus corpus N and avgdl (the ``term_stats`` query)."""
    cf = index.postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    return cf.crossJoin(F.broadcast(index.stats.select("n_docs", "avgdl")))
