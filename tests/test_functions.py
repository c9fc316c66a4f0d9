"""Time functions never depend on the session zone."""

from pyspark.sql import functions as F

from tidemark.functions.text import is_empty, split_list
from tidemark.functions.time import (epoch_ms, fmt_datetime, rowtime, rowtime_instant, to_date,
                                     to_ts, to_ymd_hms, wall_clock)
from pyspark.sql import types as T

MS = 1710037800123  # 2024-03-10 02:30:00.123 UTC: inside New York's DST gap


def _row(spark):
    df = spark.range(1).select(F.lit(MS).alias("ms"),
                               F.expr("TIMESTAMP_NTZ'2024-03-10 02:30:00.123456'").alias("ntz"))
    return df.select(
        to_date("ms").alias("d"), to_ymd_hms("ms").alias("h"),
        to_ymd_hms("ms", "Asia/Shanghai").alias("sh"), to_date(F.col("ms") - 3 * 3600_000, "Asia/Shanghai").alias("dsh"),
        fmt_datetime(rowtime(F.col("ms"))).alias("r"),
        fmt_datetime(wall_clock(rowtime_instant(F.col("ms"), "Asia/Shanghai"), T.TimestampType())).alias("ri"),
        epoch_ms("ntz").alias("e"),
        to_ts(F.lit("2024-03-10"), False).alias("t1"),
        to_ts(F.lit("2024-03-10 02:30:00"), True, "+00:00").alias("t2"),
    ).collect()[0].asDict()


def test_time_functions_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    want = {"d": "2024-03-10", "h": "2024-03-10 02:30:00", "sh": "2024-03-10 10:30:00",
            "dsh": "2024-03-10", "r": "2024-03-10 02:30:00", "ri": "2024-03-10 10:30:00",
            "e": MS, "t1": 1710000000000, "t2": 1710037800000}
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert _row(spark) == want, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_text_helpers(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "s string")
    assert [r[0] for r in df.select(is_empty("s")).collect()] == [True, True, False]
    r = spark.range(1).select(split_list(F.lit("a,b,,c")).alias("x")).collect()[0]["x"]
    assert r == ["a", "b", "", "c"]


def test_registered_tokenizer_matches_jvm_tokens(spark):
    from tidemark.functions.text import register_tokenizer, tokens
    register_tokenizer(spark)
    df = spark.createDataFrame([(1, "Été 42, été! x"), (2, ""), (3, None)], "id int, fullword string")
    df.createOrReplaceTempView("search_t")
    sql = sorted(tuple(r) for r in spark.sql(
        "SELECT id, keyword FROM search_t, LATERAL ik_analyze(fullword)").collect())
    jvm = sorted(tuple(r) for r in df.select("id", F.explode(tokens("fullword"))).collect())
    assert sql == jvm == [(1, "42"), (1, "x"), (1, "été"), (1, "été")]
