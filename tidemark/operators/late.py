"""Rows that arrive too late for their window.

The watermark at a row is the latest event time of all rows that arrived before
it, less the delay. A row is late when its window had ended by then; the
reference drops it. The running maximum in arrival order is a two-level prefix
scan: rows are range-partitioned by arrival into blocks, block maxima are scanned
in a table of blocks, and each block is scanned on its own. No task sorts more than a block.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.time import fmt_datetime, ms_to_local
from tidemark.operators.keyword import KEYWORD_SEARCH, dealt, keyword_explode
from tidemark.session import passing_path


def _written(df: DataFrame, name: str) -> DataFrame:
    path = passing_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def max_before(rows: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the largest ``value`` of all rows with a smaller ``order``
    (null for the first). Blocks are as large as the session's advisory partitions; the
    blocked rows are written once to the shared folder, so that a block stays
    what it is if an executor is lost."""
    laid = _written(rows.repartitionByRange(order).withColumn("_block", F.spark_partition_id()), "blocks")
    ahead = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per block: a small table whatever the rows
    tops = laid.groupBy("_block").agg(F.max(value).alias("_top")).select("_block", F.max("_top").over(ahead).alias("_top"))
    inside = Window.partitionBy("_block").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    return (laid.join(tops, "_block").withColumn(out, F.greatest(F.max(value).over(inside), F.col("_top")))
            .drop("_block", "_top"))


def with_lateness(page_log: DataFrame, duration_s: int = 10, delay_s: int = 3) -> DataFrame:
    """Search rows ``(seq, fullword, sec, watermark, window_end, late)``. Every page row
    moves the watermark, as in the job; ``seq`` is the arrival order. The log is
    parsed once."""
    page = F.col("page")
    at = lambda k: F.try_element_at(page, F.lit(k))
    found = (at("last_page_id") == "search") & (at("item_type") == "keyword")
    rows = _written(page_log.select("seq", F.floor(F.col("ts") / 1000).cast("bigint").alias("sec"),
                                    F.when(found, at("item")).alias("fullword")), "pages")
    marks = max_before(rows.select("seq", "sec"), "seq", "sec", "seen").select("seq", "seen")
    end = (F.floor(F.col("sec") / duration_s).cast("bigint") + 1) * duration_s
    j = rows.filter(F.col("fullword").isNotNull()).join(marks, "seq")
    return (j.withColumn("watermark", F.col("seen") - delay_s).withColumn("window_end", end)
            .withColumn("late", F.coalesce(F.col("window_end") <= F.col("watermark"), F.lit(False))).drop("seen"))


def _text(sec: str) -> Column:
    return fmt_datetime(ms_to_local(F.col(sec) * 1000))


def late_rows(lateness: DataFrame) -> DataFrame:
    """The dropped rows: ``(seq, rowtime, watermark, edt, behind_s)``."""
    return lateness.filter("late").select(
        "seq", _text("sec").alias("rowtime"), _text("watermark").alias("watermark"), _text("window_end").alias("edt"),
        (F.col("watermark") - F.col("window_end")).alias("behind_s"))


def counts_on_time(lateness: DataFrame, duration_s: int = 10, source: str = KEYWORD_SEARCH) -> DataFrame:
    """Keyword counts without the late rows: ``stt, edt, source, keyword, keyword_count``."""
    on_time = lateness.filter(~F.col("late")).withColumn("rowtime", F.col("window_end"))
    k = keyword_explode(dealt(on_time.select("fullword", "rowtime")))
    c = k.groupBy("rowtime", "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))
    c = c.withColumn("start", F.col("rowtime") - duration_s)
    return c.select(_text("start").alias("stt"), _text("rowtime").alias("edt"), F.lit(source).alias("source"),
                    "keyword", "keyword_count")
