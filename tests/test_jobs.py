"""Batch job runners end to end on files, and the sink helpers."""

import json
import os


from conftest import SF_SMALL
from tidemark.plans import jobs
from tidemark.plans import flows as pl
from tidemark.sinks.kafka import kafka_frame, to_keyed_messages
from tidemark.sinks.dim import read_dim_table
from tidemark.sources.fixtures import change_log, config_changelog, raw_log
from tidemark.sources.logs import read_log


def test_log_split_job_and_reader(spark, scratch):
    src = os.path.join(scratch, "raw")
    raw_log(spark, SF_SMALL).write.parquet(src)
    out = os.path.join(scratch, "topics")
    jobs.log_split(read_log(spark, "parquet", src), out, "a")
    got = spark.read.parquet(out).groupBy("topic").count()
    want = pl.routed_log(spark, SF_SMALL).groupBy("topic").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    kf = kafka_frame(spark.read.parquet(out))
    assert kf.columns == ["topic", "key", "value"]
    # a re-run of the same run id replaces its output instead of doubling it
    jobs.log_split(read_log(spark, "parquet", src), out, "a")
    assert spark.read.parquet(out).count() == pl.routed_log(spark, SF_SMALL).count()


def test_keyword_job_appends_bean_columns(spark, scratch):
    out = os.path.join(scratch, "kw")
    jobs.keyword_window(raw_log(spark, SF_SMALL), out, "a")
    df = spark.read.parquet(out)
    assert df.columns == ["stt", "edt", "source", "keyword", "keyword_count", "ts", "run"]
    assert df.count() == pl.keyword_page_view_window(spark, SF_SMALL).count()


def test_dim_job(spark, scratch):
    out = os.path.join(scratch, "dim")
    tables = jobs.dim(change_log(spark, SF_SMALL), config_changelog(spark), out, "a", 0)
    rejects = spark.read.schema("seq bigint, table string, type string, reason string, run string")
    assert rejects.parquet(out + "_rejects/changes").count() == 0
    assert set(tables) == {"dim_customer", "dim_part", "dim_customer_last_order"}
    cur = read_dim_table(spark, out, "dim_customer", ["c_custkey", "c_name", "c_mktsegment"])
    row = cur.orderBy("row_key").first()
    assert row["c_custkey"] == row["row_key"] and row["c_name"] and row["c_mktsegment"]


def _change(key, name, seq, src_ts=None, part=0, typ="update"):
    return (json.dumps({"table": "t", "type": typ, "data": {"id": key, "name": name}}), seq, src_ts, part)


CHANGE_ROWS = "value string, seq bigint, src_ts bigint, part int"


def _config(spark):
    cfg = {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id,name", "sink_pk": "id", "sink_extend": None}
    return spark.createDataFrame([(json.dumps({"op": "r", "before": None, "after": cfg}), 0)], "value string, seq bigint")


def _dim_rows(spark, out):
    return {r.id: r.name for r in read_dim_table(spark, out, "dim_t", ["id", "name"]).collect()}


def test_dim_runs_fold_into_one_table(spark, scratch):
    out = os.path.join(scratch, "dim")
    cfg = _config(spark)
    batch = lambda rows, run, no=0: jobs.dim(spark.createDataFrame(rows, CHANGE_ROWS), cfg, out, run, no)
    batch([_change(1, "a", 900, 1000, 1), _change(2, "b", 5, 1000, 0)], "r1")
    batch([_change(3, "c", 6, 1500, 0)], "r2")
    assert _dim_rows(spark, out) == {"1": "a", "2": "b", "3": "c"}
    # a later change in another partition, with a smaller offset, wins
    batch([_change(1, "new", 5, 2000, 0)], "r3")
    assert _dim_rows(spark, out)["1"] == "new"
    # an older change that comes late does not
    batch([_change(1, "old", 950, 1200, 1)], "r4")
    batch([_change(1, "a", 900, 1000, 1), _change(2, "b", 5, 1000, 0)], "r1")  # replay
    assert _dim_rows(spark, out) == {"1": "new", "2": "b", "3": "c"}


def test_dim_without_source_time_orders_by_run(spark, scratch):
    out = os.path.join(scratch, "dim")
    cfg = _config(spark)
    for no, (name, seq) in enumerate((("first", 900), ("second", 5))):
        jobs.dim(spark.createDataFrame([_change(1, name, seq)], CHANGE_ROWS), cfg, out, f"r{no}", no)
    assert _dim_rows(spark, out) == {"1": "second"}


def test_dim_rejects_are_written(spark, scratch):
    out = os.path.join(scratch, "dim")
    rows = [("no json", 1, None, 0), (json.dumps({"table": "t", "type": "insert"}), 2, None, 0)]
    jobs.dim(spark.createDataFrame(rows, CHANGE_ROWS), _config(spark), out, "a")
    got = spark.read.parquet(out + "_rejects/changes")
    assert sorted((r.seq, r.reason) for r in got.collect()) == [(1, "unparsable"), (2, "no_data")]


def _lines(day, n=3, start=False):
    ts = 1704067200000 + day * 86400000
    out = []
    for i in range(n):
        rec = {"common": {"mid": f"m{i}", "is_new": "0"}, "ts": ts + i}
        rec |= {"start": {"entry": "icon"}} if start else {"page": {"page_id": "p", "last_page_id": "search",
                                                                    "item": f"word{day}", "item_type": "keyword"}}
        out.append((json.dumps(rec), day * 100 + i))
    return out


def test_runs_do_not_touch_each_other(spark, scratch):
    raw = lambda rows: spark.createDataFrame(rows, "value string, seq bigint")
    kw = os.path.join(scratch, "kw")
    jobs.keyword_window(raw(_lines(0)), kw, "day0")
    jobs.keyword_window(raw(_lines(1) + [("broken", 7)]), kw, "day1")
    assert {r.keyword for r in spark.read.parquet(kw).collect()} == {"word0", "word1"}
    assert [r.seq for r in spark.read.parquet(jobs.rejects_path(kw)).collect()] == [7]
    out = os.path.join(scratch, "topics")
    jobs.log_split(raw(_lines(0)), out, "day0")
    jobs.log_split(raw(_lines(1)), out, "day1")
    assert spark.read.parquet(out).groupBy("run").count().count() == 2
    # a repeated run with fewer topics leaves nothing of its first attempt
    jobs.log_split(raw(_lines(1, start=True)), out, "day1")
    got = {(r.run, r.topic): r["count"] for r in spark.read.parquet(out).groupBy("run", "topic").count().collect()}
    assert got == {("day0", "dwd_traffic_page_log"): 3, ("day1", "dwd_traffic_start_log"): 3}
    # a stream into the same folder is a run of its own
    src = os.path.join(scratch, "src")
    raw(_lines(2)).write.parquet(src)
    stream = spark.readStream.schema("value string, seq bigint").parquet(src)
    jobs.start_log_split(spark, stream, out, f"s-{os.path.basename(scratch)}", trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(out).count() == 9


def test_run_needs_a_name(spark, scratch):
    import pytest
    with pytest.raises(ValueError):
        jobs.log_split(spark.createDataFrame(_lines(0), "value string, seq bigint"), scratch, "")


def test_outputs_reach_kafka_and_jdbc_writers(spark, scratch, monkeypatch):
    """Frames only: no broker, no database."""
    import pytest
    from tidemark.sinks import table
    seen = []
    monkeypatch.setattr(jobs, "write_topics", lambda df, servers, options: seen.append((df.columns, servers, options, df.count())))
    raw = spark.createDataFrame(_lines(0), "value string, seq bigint")
    jobs.log_split(raw, scratch, "a", kafka={"servers": "h:1", "acks": "all"})
    jobs.unique_visitors(raw, os.path.join(scratch, "u"), "a", kafka={"servers": "h:1"})
    jobs.user_jumps(raw, os.path.join(scratch, "j"), "a", kafka={"servers": "h:1"})
    assert [s[1] for s in seen] == ["h:1"] * 3 and seen[0][2] == {"acks": "all"} and seen[0][3] == 3
    assert all({"topic", "mid", "value"} <= set(s[0]) for s in seen)
    with pytest.raises(ValueError):
        table.jdbc_writer(raw, {"url": "jdbc:x"})


def test_keyed_messages_tombstone(spark):
    df = spark.createDataFrame([("a", 1, False), ("b", 2, True)], "k string, n bigint, gone boolean")
    m = {r["key"]: r["value"] for r in to_keyed_messages(df, ["k"], delete_col="gone").collect()}
    assert json.loads(m['{"k":"a"}']) == {"k": "a", "n": 1}
    assert m['{"k":"b"}'] is None


def test_ensure_dim_tables_runs_ddl(spark):
    from tidemark.operators.dim import config_state, parse_config_changes, table_ddl
    from tidemark.sinks.dim import ensure_dim_tables
    spark.sql("CREATE DATABASE IF NOT EXISTS dim")
    state = config_state(parse_config_changes(config_changelog(spark)))
    made = ensure_dim_tables(spark, table_ddl(state))
    assert sorted(made) == ["dim_customer", "dim_customer_last_order", "dim_part"]
    cols = [f.name for f in spark.table("dim.dim_customer").schema.fields]
    assert cols == ["c_custkey", "c_name", "c_mktsegment"]
    ensure_dim_tables(spark, table_ddl(state))  # idempotent
