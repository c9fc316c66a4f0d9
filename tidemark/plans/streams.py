"""The streaming jobs run for real over files, as registered queries: a log is
cut into chunks in its order of arrival, the chunks come into a folder one after
the other, and the query goes on from its checkpoint for each of them
(``availableNow``), as after a restart. What it wrote is read back.

Arrival: a row arrives up to a day after its time, by a rule (``ts`` plus ``seq`` * 7919
modulo a day), so rows of different times are mixed within and across chunks. A last chunk
holds one page record far ahead of all times, which closes what still waits;
its own rows are left out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.parse import parse_log
from tidemark.operators.split import TOPIC_PAGE
from tidemark.operators.visitor import flag_keys
from tidemark.plans import flows as pl
from tidemark.schemas import RAW_LOG
from tidemark.session import passing_path
from tidemark.sinks import files
from tidemark.sinks.runs import read_runs, run_name, write_run
from tidemark.sources.fixtures import DOC_TS, raw_log
from tidemark.sources.literal import literal_frame
from tidemark.streaming import jobs as sj

CHUNKS, CHUNK_MS, DAY_MS = 4, 8 * 86_400_000, 86_400_000
END = "~end"


def chunk_of(ts, seq) -> F.Column:
    arrives = ts + F.pmod(seq * F.lit(7919), F.lit(DAY_MS))
    return F.least(F.lit(CHUNKS - 1), F.floor((arrives - F.lit(DOC_TS)) / F.lit(CHUNK_MS))).cast("int")


def _end_line(spark: SparkSession) -> DataFrame:
    line = json.dumps({"common": {"mid": END, "is_new": "0"}, "page": {"page_id": "end", "last_page_id": "home"},
                       "ts": DOC_TS + 400 * DAY_MS})
    return literal_frame(spark, [(line, 1 << 60)], "value string, seq bigint")


def run_in_chunks(lines: DataFrame, body_of: Callable[[DataFrame, str], object]) -> None:
    """``lines`` is ``(value, seq, chunk)``; ``body_of(stream, checkpoint)`` gives a ready
    stream writer, started anew for every chunk."""
    spark = lines.sparkSession
    work = passing_path(spark, f"stream-{uuid.uuid4().hex}")
    lines.write.partitionBy("chunk").parquet(f"{work}/waiting")
    _end_line(spark).write.parquet(f"{work}/waiting/chunk={CHUNKS}")
    for k in range(CHUNKS + 1):
        if not files.exists(spark, f"{work}/waiting/chunk={k}"):
            continue
        files.move(spark, f"{work}/waiting/chunk={k}", f"{work}/in/{k}")
        stream = spark.readStream.schema(RAW_LOG).option("recursiveFileLookup", "true").parquet(f"{work}/in")
        q = body_of(stream, f"{work}/checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))


def _results(spark: SparkSession, lines: DataFrame, make: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    out = passing_path(spark, f"stream-out-{uuid.uuid4().hex}")

    def body_of(stream, checkpoint):
        def write(batch: DataFrame, batch_id: int) -> None:
            write_run(batch, out, run_name("s", batch_id), once=True)
        return make(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)

    run_in_chunks(lines, body_of)
    return read_runs(spark, out, schema + ", run string").drop("run").filter(F.col("mid") != END if "mid string" in schema
                                                                             else F.lit(True))


def _page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = pl.routed_log(spark, sf_dir, topics=(TOPIC_PAGE,))
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    return r.select("value", "seq", chunk_of(ts, F.col("seq")).alias("chunk"))


def user_jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = lambda s: sj.user_jump_stream(sj.page_log_from_topic(s), delay_ms=DAY_MS).select(
        "mid", "seq", "ts", "last_page_id")
    return _results(spark, _page_lines(spark, sf_dir), make, "mid string, seq bigint, ts bigint, last_page_id string")


def unique_visitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = lambda s: sj.unique_visitor_stream(sj.page_log_from_topic(s), delay="1 day").select(
        "mid", "seq", "ts", "visit_date")
    return _results(spark, _page_lines(spark, sf_dir), make, "mid string, seq bigint, ts bigint, visit_date string")


def keyword_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = lambda s: sj.keyword_window_stream(sj.page_log_from_topic(s), delay="1 day", with_ts=False)
    return _results(spark, _page_lines(spark, sf_dir), make,
                    "stt string, edt string, source string, keyword string, keyword_count bigint")


def flag_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival decides the anchors here: by chunk, then (ts, seq). A batch holds the key
    fields of its lines only; texts and records would fill the executors' storage memory."""
    raw = raw_log(spark, sf_dir)
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    lines = raw.select("value", "seq", F.coalesce(chunk_of(ts, F.col("seq")), F.lit(0)).alias("chunk"))
    out = passing_path(spark, f"stream-out-{uuid.uuid4().hex}")
    anchors = sj.anchor_table(spark, passing_path(spark, f"anchors-{uuid.uuid4().hex}"))

    def body_of(stream, checkpoint):
        def write(batch: DataFrame, batch_id: int) -> None:
            parsed = parse_log(batch)
            keys = flag_keys(parsed).persist()
            r = sj.flag_repair_batch(parsed, anchors, batch_id, keys=keys)
            write_run(r.filter(F.col("dirty").isNull()).select("seq", "mid", "ts", "visit_date", "is_new_in", "is_new"),
                      out, run_name("s", batch_id), once=True)
            keys.unpersist()
        return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)

    run_in_chunks(lines, body_of)
    schema = "seq bigint, mid string, ts bigint, visit_date string, is_new_in string, is_new string, run string"
    return read_runs(spark, out, schema).drop("run").filter(F.col("mid") != END)
