"""Streaming forms of the reference's five jobs.

Sources are streaming frames of ``(value, seq)`` (Kafka, or files in
tests); the operators are the batch ones wherever Spark allows them on a
stream. Visits and bounces are streaming aggregates; flag repair, whose state has
no end, is a keyed processor (:mod:`tidemark.streaming.processors`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.record import parse_record, set_sub_field
from tidemark.functions.text import is_empty
from tidemark.functions.time import arrival, rowtime_instant, to_date
from tidemark.operators.dim import config_history, config_state, parse_changes
from tidemark.operators.keyword import keyword_counts
from tidemark.operators.parse import parse_log
from tidemark.operators.split import TOPIC_DIRTY, fan_out
from tidemark.operators.visitor import anchor_days, with_anchor
from tidemark.schemas import PAGE_LOG_DDL
from tidemark.streaming.processors import VISITOR_OUT, VisitorFlagProcessor
from tidemark.sinks.dim import dim_batch
from tidemark.sinks.runs import run_name
from tidemark.sinks.versioned import VersionedTable


def log_split_stream(raw: DataFrame, zone: str = "UTC") -> DataFrame:
    """Log split job: ``(topic, seq, mid, value)`` for all six topics. Dirty
    lines bypass the keyed state, in a branch of their own (so the source is read
    twice per micro-batch)."""
    parsed = parse_log(raw)
    good = (parsed.filter(F.col("dirty").isNull())
                  .select("mid", "seq", "ts", "is_new", "value"))
    fixed = good.groupBy("mid").transformWithStateInPandas(
        VisitorFlagProcessor(zone), VISITOR_OUT, "Append", "None")
    changed = (F.col("is_new_in") == "1") & (F.col("is_new") == "0")
    rec = parse_record(F.col("value"))
    repaired = fixed.select(
        "seq", "mid", "value", F.lit(None).cast("string").alias("dirty"),
        F.when(changed, set_sub_field(rec, "common", "is_new", '"0"')).otherwise(rec).alias("rec"))
    dirty = parsed.filter(F.col("dirty").isNotNull()).select(
        F.lit(TOPIC_DIRTY).alias("topic"), "seq", "mid", "value")
    return fan_out(repaired).unionByName(dirty)


def flag_repair_batch(parsed: DataFrame, anchors: VersionedTable, batch_id: int, zone: str = "UTC",
                      salts: int = 16, keys: DataFrame | None = None) -> DataFrame:
    """T1 on one micro-batch of parsed lines, with the devices' anchors in a
    keyed table instead of keyed state: the batch's first rows per device are folded
    into the table, where an anchor that is there stays, and the table is joined back.

    The aggregate combines a device's rows map-side and the join deals them over
    ``salts`` keys, so no task holds a device. A replayed batch finds its own anchors
    and gives the same rows. No join sends its anchors to the driver. Callers hold
    ``parsed`` (it is read more than once), or only its ``keys`` (:func:`flag_keys`):
    then ``parsed`` itself, with the lines' texts and records, is read once, for the result."""
    keys = parsed if keys is None else keys
    new = anchor_days(keys, zone).withColumn("batch", F.lit(batch_id).cast("long"))
    first = lambda both: both.groupBy("mid").agg(F.min_by("days", "batch").alias("days"),
                                                 F.min("batch").alias("batch"))
    version = anchors.fold(new, first)
    known = anchors.read(version=version).join(new.select("mid").hint("merge"), "mid", "left_semi")
    return with_anchor(parsed, known.select("mid", "days"), zone, salts, keys)


def anchor_table(spark, path: str) -> VersionedTable:
    return VersionedTable(spark, path, "mid")


def log_split_batch_writer(anchors: VersionedTable, write, zone: str = "UTC", keep: int = 8):
    """``foreachBatch`` body of the log split job: repaired lines, routed into all six topics,
    to ``write(routed, batch_id)``. Versions of the anchors beyond the last ``keep`` are dropped."""
    def body(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_log(batch).persist()
        write(fan_out(flag_repair_batch(parsed, anchors, batch_id, zone)), batch_id)
        parsed.unpersist()
        if batch_id % keep == keep - 1:
            anchors.vacuum(keep)
    return body


def _topic_records(topic_stream: DataFrame) -> DataFrame:
    p = topic_stream.select("seq", "value", F.from_json("value", PAGE_LOG_DDL).alias("p"))
    return p.select("seq", "value", "p.common", "p.page", "p.ts",
                    F.try_element_at("p.common", F.lit("mid")).alias("mid"))


def page_log_from_topic(topic_stream: DataFrame) -> DataFrame:
    """The page topic read back with the declared page-log schema: the
    lines that have a device and a time (others: :func:`page_rejects_from_topic`)."""
    return _topic_records(topic_stream).filter(F.col("mid").isNotNull() & F.col("ts").isNotNull())


def page_rejects_from_topic(topic_stream: DataFrame) -> DataFrame:
    """``(seq, value, reason)`` of the lines that are no page records."""
    r = _topic_records(topic_stream)
    reason = F.when(F.col("mid").isNull(), "no_mid").when(F.col("ts").isNull(), "no_ts")
    return r.filter(reason.isNotNull()).select("seq", "value", reason.alias("reason"))


def unique_visitor_stream(page_stream: DataFrame, zone: str = "UTC", delay: str = "1 day",
                          early: bool = False) -> DataFrame:
    """T2 on a stream: ``(mid, seq, ts, visit_date, value)``, one row per
    (device, date).

    The default equals the batch form for rows up to ``delay`` late: the first
    visit start by (ts, seq), emitted when the watermark passes the end of its day.
    A streaming hash of one row per device and day, combined before the shuffle.
    ``early`` emits at once instead, the first start to *arrive* (the reference's
    moment; later arrivals of the day within ``delay`` are dropped).
    """
    lp = F.try_element_at(F.col("page"), F.lit("last_page_id"))
    src = page_stream.select(
        "mid", "seq", "ts", "value", lp.alias("last_page_id"), to_date(F.col("ts"), zone).alias("visit_date"),
        rowtime_instant(F.col("ts"), zone).alias("evt")).withWatermark("evt", delay)
    # every row moves the watermark: the filter stays above it
    row = F.struct("mid", "seq", "ts", "value", "last_page_id", "visit_date")
    starts = src.select("evt", F.inline(F.array(row))).filter(F.col("last_page_id").isNull())
    if early:
        return (starts.dropDuplicatesWithinWatermark(["mid", "visit_date"])
                      .select("mid", "seq", "ts", "visit_date", "value"))
    first = starts.groupBy(F.window("evt", "1 day"), "mid", "visit_date").agg(
        F.min_by(F.struct("seq", "ts", "value"), arrival("ts", "seq")).alias("r"))
    return first.select("mid", "r.seq", "r.ts", "visit_date", "r.value")


def user_jump_stream(page_stream: DataFrame, within_ms: int = 10_000, delay_ms: int = 0,
                     bucket_factor: int = 4) -> DataFrame:
    """T3 on a stream: ``(mid, seq, ts, last_page_id, value)``, equal to the
    batch form for rows up to ``delay_ms`` late (0: the reference's monotonous
    watermark).

    As in the batch form, rows belong to (device, time bucket), and those in the
    first ``within_ms`` of a bucket also to the bucket before. Such a group is
    complete once nothing below its end plus ``within_ms`` can arrive, hence the
    watermark's delay; then the rule is applied to its rows in (ts, seq) order. State
    is the open buckets' rows, with payload for visit starts only, and is freed
    with the bucket. A hot device is spread over its buckets.
    """
    width = int(within_ms) * int(bucket_factor)
    lp = F.try_element_at(F.col("page"), F.lit("last_page_id"))
    b = F.floor(F.col("ts") / F.lit(width)).cast("bigint")
    x = page_stream.select("mid", "seq", "ts", "value", lp.alias("last_page_id"), is_empty(lp).alias("empty"),
                           b.alias("b"))
    x = x.select("*", F.explode(F.when(F.col("ts") - F.col("b") * width < within_ms,
                                       F.array(F.col("b"), F.col("b") - 1)).otherwise(F.array("b"))).alias("bucket"))
    x = x.withColumn("evt", F.timestamp_millis(F.col("bucket") * width)).withWatermark(
        "evt", f"{int(delay_ms) + int(within_ms)} milliseconds")
    emits = F.col("empty") & (F.col("bucket") == F.col("b"))
    row = F.struct("ts", "seq", "empty", emits.alias("emits"), F.when(emits, F.col("last_page_id")).alias("last_page_id"),
                   F.when(emits, F.col("value")).alias("value"))
    g = x.groupBy(F.window("evt", f"{width} milliseconds"), "mid").agg(F.collect_list(row).alias("rows"))
    g = g.select("mid", F.array_sort("rows", lambda p, q: F.when(p["ts"] < q["ts"], -1).when(p["ts"] > q["ts"], 1)
                                     .when(p["seq"] < q["seq"], -1).when(p["seq"] > q["seq"], 1).otherwise(0)).alias("rows"))
    nxt = lambda i: F.get("rows", i + 1)
    out = F.filter("rows", lambda r, i: r["emits"] & (
        nxt(i).isNull() | (nxt(i)["ts"] - r["ts"] >= within_ms) | nxt(i)["empty"]))
    return g.select("mid", F.explode(out).alias("r")).select("mid", "r.seq", "r.ts", "r.last_page_id", "r.value")


def keyword_window_stream(page_stream: DataFrame, duration: str = "10 seconds",
                          delay: str = "3 seconds", zone: str = "UTC",
                          with_ts: bool = True) -> DataFrame:
    """Keyword job on a stream: watermark ``rowtime - delay``, append mode
    emits each window once the watermark passes its end; later rows for it
    are dropped."""
    df = (page_stream.withColumn("rowtime", rowtime_instant(F.col("ts"), zone))
                     .withWatermark("rowtime", delay))
    # Every page row must move the watermark, as in the reference (not only
    # searches): take the page map through a one-row generator so the search
    # filter stays above the watermark instead of being pushed below it.
    df = df.select("rowtime", F.inline(F.array(F.struct(F.col("page").alias("page")))))
    return keyword_counts(df, duration, zone, with_ts)


def dim_batch_writer(config_loader, root: str, run: str, config_at: str | None = None):
    """``foreachBatch`` body of the DIM job: the config is re-read for every
    micro-batch (so config changes apply from the next batch on), and the changes are
    folded into the tables; a replayed batch changes nothing. With ``config_at``
    each change follows the config of its own position."""
    def write(batch: DataFrame, batch_id: int) -> None:
        c = config_loader()
        state = config_history(c, config_at) if config_at else config_state(c)
        dim_batch(parse_changes(batch), state, root, run_name(run, batch_id), batch_id, config_at)
    return write
