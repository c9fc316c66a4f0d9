"""Steps whose memory or time in one task must not follow the size of a file or a table."""

from pyspark.sql import functions as F

from helpers import D1, log_line
from tidemark.operators import keyword as kw
from tidemark.operators.parse import parse_log
from tidemark.sources.fixtures import raw_log
from tidemark.streaming import jobs as J


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_anchors_of_a_batch_are_not_broadcast(spark, scratch):
    """the files of the anchors are small, their rows dealt over the salts are not."""
    rows = [(log_line(f"d{i}", D1 + i, "1"), i) for i in range(200)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as inside foreachBatch
    try:
        table = J.anchor_table(spark, f"{scratch}/anchors")
        r = J.flag_repair_batch(parse_log(spark.createDataFrame(rows, "value string, seq bigint")), table, 0)
        plan = _plan(r)
        assert r.count() == 200
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Broadcast" not in plan


def test_words_are_counted_in_even_shares(spark):
    """many searches in one partition are dealt out before their words are counted."""
    page = spark.range(400).coalesce(1).select(
        (F.lit(D1) + F.col("id") * 1000).alias("ts"),
        F.create_map(F.lit("last_page_id"), F.lit("search"), F.lit("item_type"), F.lit("keyword"),
                     F.lit("item"), F.concat(F.lit("w"), F.col("id").cast("string"))).alias("page"))
    shares = kw.dealt(kw.keyword_filter(page)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in shares) == 400 and max(r["count"] for r in shares) < 200
    for out in (kw.keyword_counts(page, with_ts=False), kw.keyword_counts_sql(page)):
        assert "REPARTITION_BY_NUM" in _plan(out)
        assert out.agg(F.sum("keyword_count")).first()[0] == 400


def test_events_of_one_file_are_dealt(spark, scratch):
    """a small file of events is one split, but many lines to build."""
    d = f"{scratch}/t"
    spark.range(1000).coalesce(1).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01 00:00:01").cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit('{"k": 3}').alias("props")).write.parquet(f"{d}/events.parquet")
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{d}/documents.parquet")
    log = raw_log(spark, d)
    assert "REBALANCE_PARTITIONS_BY_COL" in _plan(log) and log.count() == 1020
