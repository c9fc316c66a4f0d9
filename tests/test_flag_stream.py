"""T1 on a stream with its anchors in a table."""

import os
import random

from pyspark.sql import functions as F

from helpers import D1, DAY, log_line
from tidemark.operators.parse import parse_log
from tidemark.streaming import jobs as J

RAW = "value string, seq bigint"


def _replay(batches):
    anchors, out = {}, {}
    for rows in batches:
        for mid, ts, seq, new in sorted(rows, key=lambda r: (r[1], r[2])):
            day = ts // DAY * DAY
            anchors.setdefault(mid, day if new == "1" else day - DAY)
            out[seq] = "0" if new == "1" and day != anchors[mid] else new
    return out


def test_batches_equal_a_replay(spark, scratch):
    rng = random.Random(8)
    table = J.anchor_table(spark, f"{scratch}/anchors")
    seq, batches = 0, []
    for _ in range(4):
        rows = []
        for _ in range(60):
            seq += 1
            rows.append((rng.choice(["hot", "hot", "a", "b", f"d{seq}"]), D1 + rng.randrange(4 * DAY), seq, rng.choice(["0", "1", None])))
        batches.append(rows)
    got = {}
    for no, rows in enumerate(batches):
        lines = [(log_line(m, ts, new), s) for m, ts, s, new in rows] + [("broken", 10_000 + no)]
        for again in (False, True):  # every batch is replayed once
            r = J.flag_repair_batch(parse_log(spark.createDataFrame(lines, RAW)), table, no).collect()
            seen = {x.seq: x.is_new for x in r if x.dirty is None}
            assert not again or seen == {s: got[s] for s in seen}
            got.update(seen)
            assert [x.value for x in r if x.dirty] == ["broken"]
    assert got == _replay(batches)


def test_no_task_holds_a_device(spark, scratch):
    """A device with a third of the rows: the join deals them over its salts."""
    rows = [(log_line("hot" if i % 3 == 0 else f"d{i}", D1 + i, "1"), i) for i in range(3000)]
    table = J.anchor_table(spark, f"{scratch}/anchors")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        r = J.flag_repair_batch(parse_log(spark.createDataFrame(rows, RAW)), table, 0)
        sizes = [x["count"] for x in r.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sum(sizes) == 3000 and max(sizes) <= 300


def test_visits_are_emitted_early_on_demand(spark, scratch):
    """With early_visits the first start to arrive comes out in its own batch."""
    from tidemark.plans import jobs
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    lines = [(log_line("a", D1 + 5), 0), (log_line("a", D1 + 9), 1), (log_line("b", D1 + 7), 2)]
    spark.createDataFrame(lines, RAW).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(RAW).parquet(src)
    for early, want in ((True, 2), (False, 0)):
        o = f"{out}{early}"
        for q in jobs.start_page_consumers(spark, stream, o, f"e{early}-{os.path.basename(scratch)}",
                                           trigger={"availableNow": True}, early_visits=early):
            q.awaitTermination()
        path = os.path.join(o, jobs.TOPIC_UNIQUE_VISITOR)
        n = spark.read.schema("seq bigint, mid string").parquet(path).count() if os.path.isdir(path) else 0
        assert n == want


def test_a_batch_holds_no_texts(spark, scratch, monkeypatch):
    """F1: what a micro-batch keeps for its passes does not grow with the lines' texts."""
    from tidemark.plans import streams
    d = f"{scratch}/t"
    docs = spark.range(40, numPartitions=2).select(F.col("id").alias("doc_id"), F.concat(
        F.col("id").cast("string"), F.lit(" "), F.repeat(F.lit("word "), 20_000)).alias("text"))
    docs.write.parquet(f"{d}/documents.parquet")
    events = [(0, "2024-01-01 01:00:00", 7), (1, "2024-01-02 01:00:00", 7), (3, "2024-01-20 01:00:00", 7), (6, "2024-01-20 02:00:00", 8)]
    spark.createDataFrame(events, "event_id bigint, ts string, user_id bigint").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", F.lit("view").alias("event_type"),
        F.lit('{"k": 3}').alias("props")).write.parquet(f"{d}/events.parquet")
    stored = lambda: {i.id(): i.memSize() + i.diskSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    before, held, write = set(stored()), [], streams.write_run

    def written(*a, **b):
        write(*a, **b)
        held.append(sum(n for i, n in stored().items() if i not in before))

    monkeypatch.setattr(streams, "write_run", written)
    got = {r.seq: (r.is_new_in, r.is_new) for r in streams.flag_repair(spark, d).collect()}
    assert {s: got[s] for s in (0, 1, 3, 6)} == {0: ("1", "1"), 1: ("0", "0"), 3: ("1", "0"), 6: ("1", "1")}
    assert len(got) == 84 and 0 < max(held) < 100_000  # the texts are 4 MB
