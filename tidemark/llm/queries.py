"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (exact_dedup, line_dedup, mixing, near_dedup, phrases, pieces, quality, secrets, sharding, substring_dedup,
               suffix_dedup, topk, whitening)
from .common import real_id, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pieces.decode_all(pieces.encode(table(spark, sf_dir, "documents")))
    return d.select(real_id().alias("doc_id"), F.size("ids").alias("n_pieces"), "ids",
                    F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return d.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = suffix_dedup.dedup_suffixes(table(spark, sf_dir, "documents"))
    return d.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return d.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"))


EXACT_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


def queries() -> dict[str, Query]:
    return {"op1_secrets": op1_secrets, "op2_topk": op2_topk, "op3_sentencepiece": op3_sentencepiece,
            "op4_substring_dedup": op4_substring_dedup,
            "op5_suffix_dedup": op5_suffix_dedup,
            "op6_near_dedup": op6_near_dedup, "op7_quality": op7_quality, "op8_line_dedup": op8_line_dedup,
            "op9_exact_dedup": op9_exact_dedup, "op10_mixing": op10_mixing,
            "op11_phrases": op11_phrases, "op12_whitening": op12_whitening, "op13_sharding": op13_sharding}


def oracle_sql() -> dict[str, str]:
    return {"op1_secrets": secrets.sql(), "op2_topk": topk.SQL, "op4_substring_dedup": substring_dedup.SQL,
            "op5_suffix_dedup": suffix_dedup.SQL, "op6_near_dedup": near_dedup.SQL, "op9_exact_dedup": EXACT_SQL, "op10_mixing": mixing.SQL,
            "op11_phrases": phrases.SQL, "op13_sharding": sharding.SQL}
