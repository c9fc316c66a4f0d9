"""A training corpus from raw documents: quality filter, exact dedup, near-dedup,
mixing to target weights, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the docs of the next stage; all but the last
return the columns of ``documents``. The folders of the stages are deleted with the application.

In all stages null texts count as empty, texts of any length are read whole, an empty table
gives an empty one, and extra columns pass through under their own names, whatever these are. Empty
texts are scored like others (quality), are equal to each other (exact), classes of their
own (near), never taken (mixing: size 0), and decode to the empty text. Of rows that repeat a doc_id
with different texts each is judged by its own text; of ties in text the smallest doc_id stays, null
last; rows equal in both count once from the exact dedup on. A null source is one source,
the last; null langs and n_chars are carried along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import exact_dedup, mixing, near_dedup, pieces, quality
from tidemark.llm.common import real_id, table
from tidemark.session import passing_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (7) predicts to be of label 1."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of equal documents (9)."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (6)."""
    return near_dedup.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources at their target weights (10): documents that it
    takes twice or three times are repeated, those it doesn't take go."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids, decoded_sha256: the encoded corpus (3)."""
    d = pieces.decode_all(pieces.encode(docs))
    return d.select(real_id().alias("doc_id"), F.size("ids").alias("n_pieces"), "ids",
                    F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality_filter), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix),
          ("sentencepiece", encode)]

#: The classifier, the signatures and the sampled segmentations can't be
#: expressed in SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = passing_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
