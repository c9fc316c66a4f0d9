"""A device holding a third of all rows: results stay exact and the bounce
plan's shuffle key spreads the device over many partitions."""

from pyspark.sql import Window, functions as F

from tidemark.functions.text import is_empty
from tidemark.operators.bounce import user_jump
from tidemark.operators.unique import unique_visitor
from tidemark.plans import flows as pl

SF = "/root/testdata/sf0.01"
W = 10_000


def _hot(spark):
    page = pl.page_log(spark, SF, repaired=False)
    return page.withColumn("mid", F.when(F.col("seq") % 3 == 0, F.lit("HOT")).otherwise(F.col("mid")))


def _max_share(df, n, *keys):
    p = df.repartition(32, *keys).groupBy(F.spark_partition_id()).count()
    return p.agg(F.max("count")).collect()[0][0] / n


def test_hot_device_results_exact(spark):
    hot = _hot(spark)
    lp = F.try_element_at("page", F.lit("last_page_id"))
    w = Window.partitionBy("mid").orderBy("ts", "seq")
    naive = (hot.withColumn("e", is_empty(lp)).withColumn("nts", F.lead("ts").over(w))
                .withColumn("ne", F.lead(is_empty(lp)).over(w))
                .filter(F.col("e") & (F.col("nts").isNull() | (F.col("nts") - F.col("ts") >= W)
                                      | F.col("ne"))).select("seq"))
    ours = user_jump(hot, W).select("seq")
    assert ours.exceptAll(naive).count() == 0 and naive.exceptAll(ours).count() == 0
    day = Window.partitionBy("mid", F.to_date(F.timestamp_millis("ts"))).orderBy("ts", "seq")
    uvn = hot.filter(lp.isNull()).withColumn("rn", F.row_number().over(day)).filter("rn = 1")
    uv = unique_visitor(hot)
    assert sorted(r.seq for r in uv.collect()) == sorted(r.seq for r in uvn.collect())


def test_bounce_key_spreads_hot_device(spark):
    hot = _hot(spark).select("seq", "mid", "ts")
    n = hot.count()
    width = 4 * W
    b = F.floor(F.col("ts") / width).cast("bigint")
    x = hot.withColumn("_b", b).withColumn("_bucket", F.explode(
        F.when(F.col("ts") - F.col("_b") * width < W, F.array("_b", F.col("_b") - 1))
         .otherwise(F.array("_b"))))
    assert _max_share(hot, n, "mid") > 0.3          # the naive key: one task gets a third
    assert _max_share(x, n, "mid", "_bucket") < 0.1  # the bounce plan's key


def test_hot_device_streaming_equals_batch(spark, scratch):
    """A device holding a third of each micro-batch: the batch result."""
    import os
    from tidemark.operators.split import TOPIC_PAGE
    from tidemark.streaming import jobs as J
    sf = "/root/testdata/sf0.001"
    routed = pl.routed_log(spark, sf).filter(F.col("topic") == TOPIC_PAGE)
    hot_mid = F.when(F.col("seq") % 3 == 0, F.lit("HOT")).otherwise(F.col("mid"))
    # rewrite common.mid inside the JSON text for the hot rows
    val = F.when(F.col("seq") % 3 == 0,
                 F.regexp_replace("value", r'"mid":"[^"]*"', '"mid":"HOT"')).otherwise(F.col("value"))
    src = os.path.join(scratch, "hot")
    at = F.get_json_object("value", "$.ts").cast("bigint")
    mid_ts = routed.agg(F.percentile_approx(at, 0.5)).first()[0]
    for i, (lo, hi) in enumerate(((-1, mid_ts), (mid_ts, 1 << 62))):
        (routed.filter((at >= lo) & (at < hi))
               .select(val.alias("value"), "seq").coalesce(1).write.parquet(os.path.join(src, str(i))))
    stream = J.page_log_from_topic(
        spark.readStream.schema("value string, seq bigint").option("maxFilesPerTrigger", 1)
             .option("recursiveFileLookup", "true").parquet(src))

    def run(df, name):
        q = (df.writeStream.format("memory").queryName(name).outputMode("append")
               .option("checkpointLocation", os.path.join(scratch, "ck_" + name))
               .trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.table(name)

    page = pl.page_log(spark, sf).withColumn("mid", hot_mid)
    uv = run(J.unique_visitor_stream(stream), "hot_uv").select("seq")
    assert uv.exceptAll(unique_visitor(page).select("seq")).count() == 0
    bj = run(J.user_jump_stream(stream), "hot_bounce").select("seq")
    want = user_jump(page, W).select("seq", "ts")
    assert bj.count() > 0 and bj.exceptAll(want.select("seq")).count() == 0
    # anything still pending is in the last buckets
    end = page.agg(F.max("ts")).first()[0]
    assert want.join(bj, "seq", "left_anti").filter(F.col("ts") < end - 100_000).count() == 0
