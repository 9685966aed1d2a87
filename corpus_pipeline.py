"""A corpus pipeline of five stages, each an operator of ``irspark.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a
frame; all but the last return the columns of documents.  ``run`` writes each stage's rows as
Parquet in the shared checkpoint folder and reads them back for the next, so that a lost executor
never repeats an earlier stage.

Ids name documents: rows that repeat an id share one verdict.  Rows with a null id are never
dropped by the stages that drop by id (2 to 4).  Null texts count as empty.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from irspark.llm.decontam import contaminated
from irspark.llm.exact_dedup import exact_dedup
from irspark.llm.frames import without_ids
from irspark.llm.pieces import encode_pieces
from irspark.llm.queries import table
from irspark.llm.simhash import simhash_dedup
from irspark.llm.toxicity import train_toxicity, without_toxic
from irspark.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores below its threshold."""
    ensure_checkpoint_dir(spark)
    return without_toxic(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (lower-cased A-Z) the row with the largest id."""
    ensure_checkpoint_dir(spark)
    return without_ids(docs, exact_dedup(docs).where(~F.col("kept")), "doc_id")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id."""
    ensure_checkpoint_dir(spark)
    near = simhash_dedup(docs).where(F.col("doc_id") != F.col("component_id"))
    return without_ids(docs, near, "doc_id")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    ensure_checkpoint_dir(spark)
    return without_ids(docs, contaminated(docs, table(spark, sf_dir, "benchmark")), "doc_id")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, score, round_trip of every document left."""
    ensure_checkpoint_dir(spark)
    return encode_pieces(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash", drop_near_copies),
          ("decontamination", drop_contaminated), ("pieces", encode)]

#: SQL cannot express the trained, hashed and segmenting stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    home = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = os.path.join(home, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
