"""Runnable jobs: each wires a source to the operators and its sinks.

Batch runners take a source frame (any ``(value, seq)`` log, e.g. from
:func:`tidemark.sources.read_log`) and write to folders; the streaming
starters do the same with ``readStream`` frames and keep their offsets and
state in a checkpoint under the shared ``spark.checkpoint.dir``. Every run has
a name; runs never replace each other's output (:mod:`tidemark.sinks.runs`).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.bounce import user_jump
from tidemark.operators.dim import config_history, config_state, parse_changes, parse_config_changes
from tidemark.operators.keyword import keyword_counts
from tidemark.operators.parse import parse_log
from tidemark.operators.split import TOPIC_PAGE, fan_out, page_records
from tidemark.operators.unique import unique_visitor
from tidemark.operators.visitor import visitor_flag_repair
from tidemark.schemas import KEYWORD_BEAN
from tidemark.session import scratch_path
from tidemark.sinks.dim import dim_batch
from tidemark.sinks.kafka import write_topics, write_topics_files, write_topics_stream
from tidemark.sinks.runs import run_name
from tidemark.sinks.table import sink_columns, write_append
from tidemark.streaming import jobs as sj

# Output topic / table names of the downstream jobs.
TOPIC_UNIQUE_VISITOR = "dwd_traffic_unique_visitor_detail"
TOPIC_USER_JUMP = "dwd_traffic_user_jump_detail"
TABLE_KEYWORD_WINDOW = "dws_traffic_source_keyword_page_view_window"


def write_topics_out(routed: DataFrame, out: str, run: str, kafka: dict | None = None) -> None:
    """One write feeds every topic: the topics of a Kafka cluster when
    ``kafka`` has its ``servers`` (and producer options), else folders under ``out``."""
    if kafka:
        rest = {k: v for k, v in kafka.items() if k != "servers"}
        write_topics(routed, kafka["servers"], rest)
    else:
        write_topics_files(routed, out, run)


def _dirty(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("dirty").isNotNull()).select("seq", "value", F.col("dirty").alias("reason"))


def rejects_path(out: str) -> str:
    """Where a job that cannot route dirty lines to a topic puts them."""
    return f"{out.rstrip('/')}_rejects"


def log_split(raw: DataFrame, out: str, run: str, zone: str = "UTC", kafka: dict | None = None) -> None:
    """Parse, repair flags, route (dirty lines have their topic)."""
    write_topics_out(fan_out(visitor_flag_repair(parse_log(raw), zone)), out, run_name(run), kafka)


def unique_visitors(raw: DataFrame, out: str, run: str, zone: str = "UTC", kafka: dict | None = None) -> None:
    parsed = parse_log(raw)
    pages = page_records(visitor_flag_repair(parsed, zone))
    uv = unique_visitor(pages, zone, keep=("seq", "rec")).select(
        F.lit(TOPIC_UNIQUE_VISITOR).alias("topic"), "seq", "mid", F.to_json("rec").alias("value"))
    write_topics_out(uv, out, run_name(run), kafka)
    write_append(_dirty(parsed), rejects_path(out), run=run)


def user_jumps(raw: DataFrame, out: str, run: str, within_ms: int = 10_000, zone: str = "UTC",
               kafka: dict | None = None) -> None:
    parsed = parse_log(raw)
    pages = page_records(visitor_flag_repair(parsed, zone)).select("mid", "ts", "seq", "page", "rec")
    j = user_jump(pages, within_ms).select(
        F.lit(TOPIC_USER_JUMP).alias("topic"), "seq", "mid", F.to_json("rec").alias("value"))
    write_topics_out(j, out, run_name(run), kafka)
    write_append(_dirty(parsed), rejects_path(out), run=run)


def keyword_window(raw: DataFrame, out: str, run: str, duration: str = "10 seconds",
                   zone: str = "UTC", jdbc: dict | None = None) -> None:
    """Keyword counts into a file table, or appended to a database table when
    ``jdbc`` has its ``url`` and ``dbtable``."""
    parsed = parse_log(raw)
    res = sink_columns(keyword_counts(page_records(parsed), duration, zone), KEYWORD_BEAN.fieldNames())
    if jdbc:
        write_append(res, out, "jdbc", jdbc)
    else:
        write_append(res, out, run=run_name(run))
    write_append(_dirty(parsed), rejects_path(out), run=run)


def dim(changes_raw: DataFrame, config_raw: DataFrame, out: str, run: str, run_no: int | None = None,
        config_at: str | None = None) -> list[str]:
    """Fold one batch of changes into the dimension tables of the current
    config (created if missing); changes that cannot be routed, and config rows that
    cannot be used, go to the rejects. Returns the tables. ``config_at`` names a position
    that both logs carry (``seq`` or ``src_ts``): each change then follows the
    config of its own time. ``run_no`` orders the runs of a source without times and is needed there."""
    if run_no is None and "src_ts" not in changes_raw.columns:
        raise ValueError("changes without src_ts need the order of this run: run_no")
    changes = parse_config_changes(config_raw)
    state = config_history(changes, config_at) if config_at else config_state(changes)
    return dim_batch(parse_changes(changes_raw), state, out, run_name(run), run_no or 0, config_at)


# --- streaming ---------------------------------------------------------------

def _files_sink(df: DataFrame, out: str, run: str, checkpoint: str, trigger: dict | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        write_topics_files(batch, out, run_name(run, batch_id), once=True)
    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def _topics_sink(df: DataFrame, out: str, run: str, checkpoint: str, trigger: dict | None, kafka: dict | None):
    if kafka:
        rest = {k: v for k, v in kafka.items() if k != "servers"}
        return write_topics_stream(df, kafka["servers"], checkpoint, rest, trigger)
    return _files_sink(df, out, run, checkpoint, trigger)


def _checkpoint(spark: SparkSession, job: str, run: str) -> str:
    """A run's checkpoint: its batch ids go on where they were, and another
    run has another checkpoint and other partitions."""
    return scratch_path(spark, f"ckpt/{job}/{run_name(run)}")


def start_log_split(spark: SparkSession, raw_stream: DataFrame, out: str, run: str,
                    zone: str = "UTC", trigger: dict | None = None, kafka: dict | None = None):
    """The anchors of the flag repair are a table beside the checkpoint, ``anchors``; one
    read of the source per micro-batch serves them and all topics."""
    checkpoint = _checkpoint(spark, "log_split", run)

    def write(routed: DataFrame, batch_id: int) -> None:
        if kafka:
            write_topics_out(routed, out, run_name(run), kafka)
        else:
            write_topics_files(routed, out, run_name(run, batch_id), once=True)

    body = sj.log_split_batch_writer(sj.anchor_table(spark, f"{checkpoint}_anchors"), write, zone)
    w = raw_stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def start_page_consumers(spark: SparkSession, page_topic_stream: DataFrame, out: str, run: str,
                         zone: str = "UTC", trigger: dict | None = None, kafka: dict | None = None,
                         jdbc: dict | None = None, early_visits: bool = False):
    """Unique visitors, bounces and keyword windows off the page topic; each
    query writes its own topic or folder ``out/<topic or table>`` (no two
    queries commit into one folder). Lines that are no page records go to
    ``out/rejects``. ``early_visits`` emits a visit when it arrives (the reference's
    moment) instead of when its day is complete."""
    pages = sj.page_log_from_topic(page_topic_stream)
    uv = sj.unique_visitor_stream(pages, zone, early=early_visits).select(
        F.lit(TOPIC_UNIQUE_VISITOR).alias("topic"), "seq", "mid", "value")
    uj = sj.user_jump_stream(pages).select(
        F.lit(TOPIC_USER_JUMP).alias("topic"), "seq", "mid", "value")
    kw = sink_columns(sj.keyword_window_stream(pages, zone=zone), KEYWORD_BEAN.fieldNames())

    def append_kw(batch: DataFrame, batch_id: int) -> None:
        if jdbc:
            write_append(batch, out, "jdbc", jdbc)
        else:
            write_append(batch, os.path.join(out, TABLE_KEYWORD_WINDOW), run=run_name(run, batch_id), once=True)

    def append_rejects(batch: DataFrame, batch_id: int) -> None:
        write_append(batch, os.path.join(out, "rejects"), run=run_name(run, batch_id), once=True)

    rejects = (sj.page_rejects_from_topic(page_topic_stream).writeStream.foreachBatch(append_rejects)
               .option("checkpointLocation", _checkpoint(spark, "page_rejects", run)))
    return [
        _topics_sink(uv, os.path.join(out, TOPIC_UNIQUE_VISITOR), run,
                     _checkpoint(spark, "unique_visitor", run), trigger, kafka),
        _topics_sink(uj, os.path.join(out, TOPIC_USER_JUMP), run,
                     _checkpoint(spark, "user_jump", run), trigger, kafka),
        (kw.writeStream.foreachBatch(append_kw)
           .option("checkpointLocation", _checkpoint(spark, "keyword_window", run))
           .trigger(**(trigger or {"processingTime": "10 seconds"})).start()),
        (rejects.trigger(**trigger) if trigger else rejects).start(),
    ]


def start_dim(spark: SparkSession, changes_stream: DataFrame, config_loader, out: str, run: str,
              trigger: dict | None = None, config_at: str | None = None):
    """``config_loader`` returns the config changelog ``(value, seq)``; it
    is called for every micro-batch."""
    loader = lambda: parse_config_changes(config_loader())
    w = (changes_stream.writeStream.foreachBatch(sj.dim_batch_writer(loader, out, run, config_at))
         .option("checkpointLocation", _checkpoint(spark, "dim", run)))
    return (w.trigger(**trigger) if trigger else w).start()


def page_topic(routed_folder: str) -> str:
    """The page topic's folder in a log-split output (a file stream source
    with ``recursiveFileLookup``)."""
    return os.path.join(routed_folder, f"topic={TOPIC_PAGE}")
