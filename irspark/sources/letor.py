"""Ranking-data text formats.  IMAT style: ``label i:v i:v ... # qid``; LETOR style:
``label qid:q i:v ...``.  Parsed with built-in string functions into
(label INT, qid STRING, features MAP<INT, DOUBLE>)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_letor(lines: DataFrame, style: str = "imat", col: str = "value") -> DataFrame:
    v = F.trim(F.col(col))
    if style == "imat":
        body = F.trim(F.regexp_extract(v, r"^([^#]*)", 1))
        qid = F.trim(F.regexp_extract(v, r"#\s*(\S+)", 1))
    elif style == "letor":
        body = F.trim(F.regexp_replace(F.regexp_extract(v, r"^([^#]*)", 1), r"qid:\S+", ""))
        qid = F.regexp_extract(v, r"qid:(\S+)", 1)
    else:
        raise ValueError(f"unknown style {style}")
    label = F.regexp_extract(body, r"^(\S+)", 1).cast("double").cast("int")
    pairs = F.regexp_extract_all(body, F.lit(r"(\d+:\S+)"), 1)
    feats = F.map_from_entries(F.transform(pairs, lambda p: F.struct(
        F.split(p, ":").getItem(0).cast("int").alias("k"), F.split(p, ":").getItem(1).cast("double").alias("v"))))
    return lines.select(label.alias("label"), qid.alias("qid"), feats.alias("features"))


def read_letor(spark, path: str, style: str = "imat") -> DataFrame:
    return parse_letor(spark.read.text(path), style)


def _fmt(v: F.Column) -> F.Column:
    # integral values print without a fraction, others with Spark's shortest form
    return F.when(v == F.floor(v), F.floor(v).cast("bigint").cast("string")).otherwise(v.cast("string"))


def to_letor_lines(df: DataFrame) -> DataFrame:
    """(label, qid, features map) -> ``label qid:q i:v ...`` with features in ascending index."""
    entries = F.array_sort(F.map_entries("features"))
    feats = F.array_join(F.transform(entries, lambda e: F.concat(e["key"].cast("string"), F.lit(":"), _fmt(e["value"]))), " ")
    return df.select(F.concat_ws(" ", F.col("label").cast("string"), F.concat(F.lit("qid:"), F.col("qid")), feats).alias("value"))


def describe_letor(df: DataFrame) -> DataFrame:
    """One row: rows, queries, docs per query min/avg/max, label histogram (map), number of
    distinct feature indexes and the mean fill rate of features (present / distinct)."""
    per_q = df.groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    q = per_q.agg(F.count(F.lit(1)).alias("n_queries"), F.min("n").alias("docs_min"), F.avg("n").alias("docs_avg"),
                  F.max("n").alias("docs_max"))
    # label histogram as text 'label:count,...' (few labels, so one small collect_list)
    labels = (df.groupBy("label").agg(F.count(F.lit(1)).alias("c"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("label", "c"))),
                                            lambda e: F.concat(e["label"].cast("string"), F.lit(":"), e["c"].cast("string"))),
                                ",").alias("label_hist")))
    fe = df.select(F.explode(F.map_keys("features")).alias("k"))
    nf = fe.agg(F.countDistinct("k").alias("n_features"), F.count(F.lit(1)).alias("n_values"))
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    out = rows.crossJoin(F.broadcast(q)).crossJoin(F.broadcast(labels)).crossJoin(F.broadcast(nf))  # one-row aggregates
    return out.withColumn("fill_rate", F.col("n_values") / (F.col("n_rows") * F.col("n_features"))).drop("n_values")
