"""Batch = stream: the same rows through files + ``availableNow`` give the
batch result, except rows still waiting for a watermark."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators.split import TOPIC_PAGE
from tidemark.plans import flows as pl
from tidemark.schemas import RAW_LOG
from tidemark.sinks.dim import read_dim_table
from tidemark.operators.dim import latest_per_key
from tidemark.sources.fixtures import change_log
from tidemark.streaming import jobs as J

CHUNKS = 4


def _write_chunks(df, path, n_seq=1000):
    step = n_seq // CHUNKS
    at = F.coalesce(F.get_json_object("value", "$.ts").cast("bigint"), F.lit(0))
    marks = [r[0] for r in df.select(at.alias("t")).orderBy("t").collect()]
    cuts = [marks[i * len(marks) // CHUNKS] for i in range(1, CHUNKS)]
    for i, (lo, hi) in enumerate(zip([-1, *cuts], [*cuts, 1 << 62])):
        (df.filter((at >= lo) & (at < hi)).coalesce(1).write.parquet(os.path.join(path, f"part{i}")))


def _stream(spark, path, schema=RAW_LOG):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                 .option("recursiveFileLookup", "true").parquet(path))


def _run(df, name, scratch):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
           .option("checkpointLocation", os.path.join(scratch, "ck_" + name))
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)


@pytest.fixture(scope="module")
def sources(spark):
    import tempfile
    d = tempfile.mkdtemp(prefix="run-stream-")
    from tidemark.sources.fixtures import raw_log
    _write_chunks(raw_log(spark, SF_SMALL), os.path.join(d, "raw"))
    page = pl.routed_log(spark, SF_SMALL).filter(F.col("topic") == TOPIC_PAGE).select("value", "seq")
    _write_chunks(page, os.path.join(d, "page"))
    return d


def _norm(df):
    v = F.coalesce(F.to_json(F.try_parse_json("value")), F.col("value"))
    return df.select("topic", "seq", v.alias("v"))


def test_log_split_stream(spark, sources, scratch):
    s = _run(J.log_split_stream(_stream(spark, os.path.join(sources, "raw"))), "split", scratch)
    b = pl.routed_log(spark, SF_SMALL)
    assert s.count() == b.count()
    assert _norm(s).exceptAll(_norm(b)).count() == 0


def _page_stream(spark, sources):
    return J.page_log_from_topic(_stream(spark, os.path.join(sources, "page"),
                                         "value string, seq bigint"))


def test_unique_visitor_stream(spark, sources, scratch):
    s = _run(J.unique_visitor_stream(_page_stream(spark, sources)), "uv", scratch).select("mid", "visit_date", "seq")
    b = pl.unique_visitors(spark, SF_SMALL).select("mid", "visit_date", "seq")
    assert s.count() > 0 and s.exceptAll(b).count() == 0
    # what is missing still waits: days within the delay of the end
    last = b.agg(F.max("visit_date")).first()[0]
    assert b.exceptAll(s).filter(F.col("visit_date") < F.date_sub(F.lit(last).cast("date"), 1).cast("string")).count() == 0


def test_user_jump_stream(spark, sources, scratch):
    s = _run(J.user_jump_stream(_page_stream(spark, sources)), "bounce", scratch)
    b = pl.user_jumps(spark, SF_SMALL)
    assert s.count() > 0 and s.select("seq").exceptAll(b.select("seq")).count() == 0
    # anything missing must still wait: the last buckets
    end = pl.page_log(spark, SF_SMALL).agg(F.max("ts")).first()[0]
    assert b.join(s.select("seq"), "seq", "left_anti").filter(F.col("ts") < end - 100_000).count() == 0


def test_keyword_window_stream(spark, sources, scratch):
    s = _run(J.keyword_window_stream(_page_stream(spark, sources), with_ts=False), "kw", scratch)
    b = pl.keyword_page_view_window(spark, SF_SMALL, with_ts=False)
    assert s.count() > 0
    assert s.exceptAll(b).count() == 0
    emitted_until = s.agg(F.max("edt")).collect()[0][0]
    pending = b.exceptAll(s)
    assert pending.filter(F.col("edt") <= emitted_until).count() == 0


def test_dim_stream(spark, scratch):
    root = os.path.join(scratch, "dim")
    src_dir = os.path.join(scratch, "changes")
    change_log(spark, SF_SMALL).write.parquet(src_dir)
    writer = J.dim_batch_writer(lambda: pl_config(spark), root, "r")
    stream = (spark.readStream.schema("value string, seq bigint").option("maxFilesPerTrigger", 2)
                   .parquet(src_dir))
    q = (stream.writeStream.foreachBatch(writer)
               .option("checkpointLocation", os.path.join(scratch, "ck_dim"))
               .trigger(availableNow=True).start())
    q.awaitTermination()
    want = latest_per_key(pl.dim_routed(spark, SF_SMALL))
    for table, cols in (("dim_customer", ["c_custkey", "c_name", "c_mktsegment"]),
                        ("dim_part", ["p_partkey", "p_name", "p_brand"])):
        got = read_dim_table(spark, root, table, cols)
        w = want.filter(F.col("sink_table") == table).select(
            "row_key", *[F.try_variant_get(F.col("data")[c], "$", "string").alias(c) for c in cols])
        assert got.count() == w.count() > 0
        assert got.exceptAll(w).count() == 0


def pl_config(spark):
    from tidemark.operators.dim import parse_config_changes
    from tidemark.sources.fixtures import config_changelog
    return parse_config_changes(config_changelog(spark))


def test_dic_lookup_stream_static(spark, scratch):
    from tidemark.operators.dic import code_dictionary, dic_lookup, status_code
    from tidemark.sources.fixtures import table
    src = os.path.join(scratch, "orders")
    o = table(spark, SF_SMALL, "orders").select("o_orderkey", "o_orderstatus")
    o.write.parquet(src)
    s = spark.readStream.schema(o.schema).parquet(src)
    fact = s.withColumn("dic_code", status_code("o_orderstatus"))
    out = _run(dic_lookup(fact, code_dictionary(spark)), "dic_stream", scratch)
    want = dic_lookup(o.withColumn("dic_code", status_code("o_orderstatus")), code_dictionary(spark))
    assert out.count() == want.count()
    assert out.exceptAll(want).count() == 0


def test_keyword_sql_stream_equals_dataframe_stream(spark, sources, scratch):
    from tidemark.operators.keyword import keyword_counts_sql
    a = _run(keyword_counts_sql(_page_stream(spark, sources)), "kw_sql", scratch)
    b = _run(J.keyword_window_stream(_page_stream(spark, sources), with_ts=False), "kw_df", scratch)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_dim_stream_config_change_applies_from_next_batch(spark, scratch):
    import json
    from tidemark.operators.dim import parse_config_changes
    from tidemark.sources.logs import from_rows

    def change(table, key):
        return json.dumps({"table": table, "type": "insert", "data": {"id": key, "name": f"n{key}"}})

    def tp(src):
        return {"source_table": src, "sink_table": "dim_" + src, "sink_columns": "id,name",
                "sink_pk": "id", "sink_extend": None}

    cfg_dir, src_dir, root = (os.path.join(scratch, n) for n in ("cfg", "src", "dim"))
    from_rows(spark, [json.dumps({"op": "r", "before": None, "after": tp("a")})]).write.parquet(
        os.path.join(cfg_dir, "0"))
    loader = lambda: parse_config_changes(
        spark.read.schema("value string, seq bigint").option("recursiveFileLookup", "true")
             .parquet(cfg_dir))
    from_rows(spark, [change("a", 1), change("b", 1)]).write.parquet(os.path.join(src_dir, "0"))
    stream = (spark.readStream.schema("value string, seq bigint")
                   .option("recursiveFileLookup", "true").parquet(src_dir))
    q = (stream.writeStream.foreachBatch(J.dim_batch_writer(loader, root, "r"))
               .option("checkpointLocation", os.path.join(scratch, "ck_dim_cfg"))
               .trigger(processingTime="1 second").start())
    try:
        q.processAllAvailable()
        # config for table b arrives; the next batch routes b's changes
        rows = [(json.dumps({"op": "c", "before": None, "after": tp("b")}), 1)]
        spark.createDataFrame(rows, "value string, seq bigint").write.parquet(os.path.join(cfg_dir, "1"))
        spark.createDataFrame([(change("b", 2), 5)], "value string, seq bigint").write.parquet(
            os.path.join(src_dir, "1"))
        q.processAllAvailable()
    finally:
        q.stop()
    got = [[tuple(r) for r in read_dim_table(spark, root, t, ["id", "name"]).collect()] for t in ("dim_a", "dim_b")]
    assert got == [[("1", "1", "n1")], [("2", "2", "n2")]]
