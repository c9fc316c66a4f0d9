"""Bounce detection, batch form.

A record whose ``last_page_id`` is empty (null or "") starts a visit. It is a
bounce when the device's next record (by ts, then arrival) is not within
``within_ms``, or is itself a visit start. If the next record within the
limit continues the visit, nothing is emitted. Closed form::

    empty(lp) AND (next IS NULL OR next.ts - ts >= within OR empty(next.lp))

Plan (skew-safe ``lead``): rows are partitioned by (mid, time bucket of
``bucket_factor * within_ms``), and the rows in the first ``within_ms`` of a
bucket are also copied into the previous bucket. Any next record closer than
the limit is then in the same partition, and a missing one means a gap of at
least the limit — so the result is exact, while a device with a third of
all rows is spread over many tasks instead of one sort. The copies are
``1 / bucket_factor`` of the rows. The streaming form (buckets closed by the watermark) is
:func:`tidemark.streaming.jobs.user_jump_stream`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.text import is_empty


def user_jump(page_log: DataFrame, within_ms: int = 10_000,
              bucket_factor: int = 4) -> DataFrame:
    """Rows of ``page_log`` that are bounces (its own columns)."""
    width = int(within_ms) * int(bucket_factor)
    lp = F.try_element_at(F.col("page"), F.lit("last_page_id"))
    cols = page_log.columns
    payload = [c for c in cols if c not in ("mid", "ts", "seq")]
    b = F.floor(F.col("ts") / F.lit(width)).cast("bigint")
    x = (page_log.withColumn("_empty", is_empty(lp))
                 .withColumn("_b", b)
                 .withColumn("_bucket", F.explode(
                     F.when(F.col("ts") - F.col("_b") * F.lit(width) < F.lit(within_ms),
                            F.array(F.col("_b"), F.col("_b") - 1))
                      .otherwise(F.array(F.col("_b"))))))
    # Only a visit start in its own bucket can be emitted: other rows and the
    # copies cross the shuffle without their payload.
    emits = F.col("_empty") & (F.col("_bucket") == F.col("_b"))
    x = x.select("mid", "ts", "seq", "_empty", "_b", "_bucket",
                 *[F.when(emits, F.col(c)).alias(c) for c in payload])
    w = Window.partitionBy("mid", "_bucket").orderBy("ts", "seq")
    x = (x.withColumn("_next_ts", F.lead("ts").over(w))
          .withColumn("_next_empty", F.lead("_empty").over(w)))
    hit = (F.col("_bucket") == F.col("_b")) & F.col("_empty") & (
        F.col("_next_ts").isNull()
        | (F.col("_next_ts") - F.col("ts") >= F.lit(within_ms))
        | F.col("_next_empty"))
    return x.filter(hit).select(*cols)
