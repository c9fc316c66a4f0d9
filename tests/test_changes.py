"""K2: the changelog of a keyed table, and W4: late rows."""

import json
import random

from pyspark.sql import functions as F

from helpers import D1, log_line, pages
from tidemark.operators.late import counts_on_time, late_rows, max_before, with_lateness
from tidemark.sinks.kafka import compacted, from_messages, keyed_changes, to_keyed_messages

ROW = "a string, b bigint, v string, w double"


def test_changes_turn_one_version_into_the_next(spark):
    old = spark.createDataFrame([("k", 1, "x", 1.0), ("k", 2, None, None), ("k", 3, "same", 0.0), (None, 4, "n", 1.0), ("e", 5, "", None)], ROW)
    new = spark.createDataFrame([("k", 1, "y", 1.0), ("k", 2, "", None), ("k", 3, "same", 0.0), (None, 4, "n", 2.0),
                                 ("e", 5, None, None), ("new", 9, "z", 1.0)], ROW)
    m = {r["key"]: r["value"] and json.loads(r["value"]) for r in keyed_changes(old, new, ["a", "b"]).collect()}
    assert set(m) == {'{"a":"k","b":1}', '{"a":"k","b":2}', '{"b":4}', '{"a":"e","b":5}', '{"a":"new","b":9}'}
    back = {r["key"]: r["value"] for r in keyed_changes(new, old, ["a", "b"]).collect()}
    assert back['{"a":"new","b":9}'] is None and len(back) == 5
    assert keyed_changes(old, old, ["a", "b"]).count() == 0


def test_replay_of_random_versions(spark):
    rng = random.Random(6)
    versions = [{k: (rng.choice(["x", None, "", "y"]), rng.choice([1.0, None])) for k in rng.sample(range(30), 15)} for _ in range(5)]
    frames = [spark.createDataFrame([(f"k{k % 3}", k, *v) for k, v in d.items()], ROW) for d in versions]
    log = to_keyed_messages(frames[0], ["a", "b"]).withColumn("seq", F.lit(0))
    for i in range(1, 5):
        log = log.unionByName(keyed_changes(frames[i - 1], frames[i], ["a", "b"]).withColumn("seq", F.lit(i)))
        got = from_messages(compacted(log), ROW)
        assert sorted(map(str, got.collect())) == sorted(map(str, frames[i].collect()))


def test_running_maximum_in_arrival_order(spark):
    rng = random.Random(2)
    rows = [(i * 3, rng.randrange(1000)) for i in range(500)]
    df = spark.createDataFrame(rng.sample(rows, 500), "seq bigint, v bigint").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.seq: r.m for r in max_before(df, "seq", "v", "m").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    top = None
    for seq, v in rows:
        assert got[seq] == top
        top = v if top is None else max(top, v)


def _search(at_s, word, mid="m"):
    return json.dumps({"common": {"mid": mid}, "ts": D1 + at_s * 1000,
                       "page": {"last_page_id": "search", "item_type": "keyword", "item": word}})


def test_late_rows(spark):
    """A row is late once a row 3 s past its window's end has arrived."""
    lines = [_search(1, "a"), log_line("n", D1 + 12_000), _search(2, "in time"), log_line("n", D1 + 13_000), _search(3, "late"),
             _search(11, "b"), log_line("n", D1 + 60_000), _search(59, "old"), _search(57, "kept b")]
    x = with_lateness(pages(spark, lines))
    assert [(r.seq, r.behind_s, r.edt) for r in late_rows(x).orderBy("seq").collect()] == [(4, 0, "2024-01-01 00:00:10")]
    got = {(r.stt, r.keyword): r.keyword_count for r in counts_on_time(x).collect()}
    assert got == {("2024-01-01 00:00:00", w): 1 for w in ("a", "in", "time")} | {("2024-01-01 00:00:10", "b"): 1} | {
        ("2024-01-01 00:00:50", w): 1 for w in ("old", "kept", "b")}


def test_late_rows_of_nothing(spark):
    x = with_lateness(pages(spark, [log_line("n", D1)]))
    assert late_rows(x).count() == 0 and counts_on_time(x).count() == 0
