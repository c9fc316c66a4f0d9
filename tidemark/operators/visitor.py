"""New-visitor flag repair, batch form.

Rule (one state per device, written once by its first record): the anchor
date is the record's own date when ``is_new = '1'``, else the day before.
Later a record with ``is_new = '1'`` on another date than the anchor gets
``is_new = '0'``.

Plan: the anchor is a hash aggregate per ``mid`` (``min_by`` of a day number over
(ts, seq) packed in one decimal, so a hot device is reduced map-side before
the shuffle) joined back on ``mid``. Good rows lose their text (``value``).
The join is planned by AQE from measured sizes (broadcast when the anchor
table is small, else sort-merge with skewed partitions split), so no device
is ever sorted in one task. On a stream the anchors are a table that every
micro-batch folds its own into (:func:`tidemark.streaming.jobs.flag_repair_batch`), or the
state of :class:`tidemark.streaming.processors.VisitorFlagProcessor`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.record import set_sub_field
from tidemark.functions.time import arrival, to_date

DAY_MS = 24 * 60 * 60 * 1000


def flag_keys(parsed: DataFrame) -> DataFrame:
    """What anchors are made of: the key fields of parsed lines, without text and record."""
    return parsed.select("mid", "seq", "ts", "is_new", "dirty")


def anchor_days(parsed: DataFrame, zone: str = "UTC") -> DataFrame:
    """``(mid, days)``: the anchor date (days since 1970) that each device's first
    good row sets. Fixed-width buffers (days, one packed decimal) keep this a
    hash aggregate, so a hot device is one row per task before the shuffle."""
    candidate = F.when(F.col("is_new") == "1", to_date(F.col("ts"), zone)).otherwise(
        to_date(F.col("ts") - F.lit(DAY_MS), zone))
    return (parsed.filter(F.col("dirty").isNull()).groupBy("mid")
            .agg(F.min_by(F.unix_date(candidate.cast("date")), arrival("ts", "seq")).alias("days")))


def with_anchor(parsed: DataFrame, anchors: DataFrame, zone: str = "UTC", salts: int = 1,
                keys: DataFrame | None = None) -> DataFrame:
    """Replace ``is_new`` (and ``rec.common.is_new``) on good rows by the devices' anchors
    ``(mid, days)``; dirty rows pass through unchanged. Adds ``is_new_in`` and
    ``visit_date``. ``salts`` above 1 deals a device's rows over so many keys and copies its
    anchor to those that occur, for callers whose join is not split at run time; both
    sides are shuffled then, as the size of a growing table of anchors is not known to the planner.
    Which salts occur is read from ``keys``, if given: :func:`flag_keys` of ``parsed``, held by the caller."""
    good = F.col("dirty").isNull()
    visit_date = to_date(F.col("ts"), zone)
    anchors = anchors.select(F.col("mid").alias("_jk"), F.date_from_unix_date("days").cast("string").alias("anchor"))
    # Dirty rows need no anchor: keys of their own, which match nothing, spread
    # a flood of unparsable lines (all NULL mid) over every task. A good row is
    # its record; only dirty rows keep their text through the join.
    jk = F.when(good, F.col("mid")).otherwise(
        F.concat(F.lit("\u0000dirty:"), F.monotonically_increasing_id().cast("string")))
    left = parsed.withColumn("_jk", jk)
    if "value" in parsed.columns:
        left = left.withColumn("value", F.when(~good, F.col("value")))
    on = ["_jk"]
    if salts > 1:
        on = ["_jk", "_salt"]
        salt = F.pmod(F.xxhash64("ts", "seq"), F.lit(salts)).cast("int").alias("_salt")
        left = left.withColumn("_salt", salt)
        met = (parsed if keys is None else keys).filter(good).select(F.col("mid").alias("_jk"), salt).distinct()
        anchors = met.join(anchors.hint("merge"), "_jk").hint("merge")
    j = left.join(anchors, on, "left").drop(*on)
    changed = good & (F.col("is_new") == "1") & (visit_date != F.col("anchor"))
    keep = [c for c in parsed.columns if c not in ("is_new", "rec")]
    return j.select(
        *keep,
        F.when(changed, set_sub_field("rec", "common", "is_new", '"0"'))
         .otherwise(F.col("rec")).alias("rec"),
        F.col("is_new").alias("is_new_in"),
        F.when(changed, F.lit("0")).otherwise(F.col("is_new")).alias("is_new"),
        F.when(good, visit_date).alias("visit_date"))


def visitor_flag_repair(parsed: DataFrame, zone: str = "UTC") -> DataFrame:
    """T1 over a whole log: anchors from the log itself (see the module)."""
    return with_anchor(parsed, anchor_days(parsed, zone), zone)
