"""Streaming edge cases: pattern timeouts by event-time timers (C3, W5) and
late rows dropped by the keyword watermark (W2, W4)."""

import json
import os

from tidemark.streaming import jobs as J


BASE = 1704067200000  # 2024-01-01 UTC; epoch 0 would sit on the initial watermark


def _page(mid, ts, lp=None, item=None, it=None):
    ts = BASE + ts
    page = {"page_id": "p"}
    if lp is not None:
        page["last_page_id"] = lp
    if item is not None:
        page["item"], page["item_type"] = item, it
    return json.dumps({"common": {"mid": mid}, "page": page, "ts": ts})


def _files(spark, root, batches):
    seq = 0
    for i, lines in enumerate(batches):
        rows = []
        for line in lines:
            rows.append((line, seq))
            seq += 1
        spark.createDataFrame(rows, "value string, seq bigint").coalesce(1).write.parquet(
            os.path.join(root, f"part{i}"))


def _stream(spark, root):
    s = (spark.readStream.schema("value string, seq bigint").option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(root))
    return J.page_log_from_topic(s)


def _run(df, name, scratch):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
           .option("checkpointLocation", os.path.join(scratch, "ck_" + name))
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_bounce_timers(spark, scratch):
    s = 1000
    c3 = [
        _page("a", 10 * s),
        _page("b", 12 * s), _page("b", 15 * s, "home"),
        _page("c", 12 * s), _page("c", 30 * s, "home"),
        _page("d", 31 * s), _page("d", 32 * s),
        _page("e", 0), _page("e", 10 * s, "home"),
        _page("f", 0), _page("f", 9999, "home"),
        _page("g", 5 * s, "detail"),
        _page("h", 0, ""), _page("h", 1 * s),
    ]
    root = os.path.join(scratch, "bounce_src")
    # later rows of another device only move the watermark forward
    _files(spark, root, [c3, [_page("z", 100 * s, "x")], [_page("z", 200 * s, "x")]])
    out = _run(J.user_jump_stream(_stream(spark, root)), "c3_stream", scratch)
    assert sorted(r.seq for r in out.collect()) == [0, 3, 5, 6, 7, 12, 13]


def test_keyword_late_rows_dropped(spark, scratch):
    s = 1000
    root = os.path.join(scratch, "kw_src")
    # Spark drops rows older than the watermark of the batch before (W4), and
    # every page row - not only searches - moves the watermark.
    _files(spark, root, [
        [_page("m", 100 * s, "search", "red", "keyword")],
        [_page("m", 200 * s, "search", "blue", "keyword")],
        [_page("m", 10 * s, "search", "late", "keyword"), _page("m", 300 * s, "home")],
        [_page("m", 400 * s, "home")],
    ])
    out = _run(J.keyword_window_stream(_stream(spark, root), with_ts=False), "kw_late", scratch)
    got = sorted((r.stt, r.keyword, r.keyword_count) for r in out.collect())
    assert got == [("2024-01-01 00:01:40", "red", 1), ("2024-01-01 00:03:20", "blue", 1)]


def _shuffled(rng, n, devices, delay):
    """Rows (device, ts, last page) in an order where none comes more than
    ``delay`` after a later one, cut into micro-batches."""
    rows = [(rng.choice(devices), rng.randrange(0, 3_600_000), rng.choice([None, None, "", "home"])) for _ in range(n)]
    rows.sort(key=lambda r: r[1] + rng.random() * delay)
    size = n // 4
    return [rows[i:i + size] for i in range(0, n, size)]


def _batch_pages(spark, batches):
    from tidemark.operators.parse import parse_log
    from tidemark.operators.split import page_records
    rows, seq = [], 0
    for lines in batches:
        for line in lines:
            rows.append((line, seq))
            seq += 1
    return page_records(parse_log(spark.createDataFrame(rows, "value string, seq bigint")))


def test_disordered_streams_equal_batch(spark, scratch):
    import random
    from tidemark.operators.bounce import user_jump
    from tidemark.operators.unique import unique_visitor
    far = 10 * 86_400_000
    for delay in (0, 600_000):
        rng = random.Random(delay)
        devices = ["hot"] * 4 + list("abcdefgh")
        batches = [[_page(m, ts, lp) for m, ts, lp in b] for b in _shuffled(rng, 240, devices, delay)]
        batches += [[_page("z", far, "x")], [_page("z", far + 1, "x")]]  # move the watermark past all
        root = os.path.join(scratch, f"src{delay}")
        _files(spark, root, batches)
        pages = _batch_pages(spark, batches[:-2])
        got = _run(J.user_jump_stream(_stream(spark, root), delay_ms=delay), f"jump{delay}", scratch)
        assert sorted(r.seq for r in got.collect()) == sorted(r.seq for r in user_jump(pages).collect())
        got = _run(J.unique_visitor_stream(_stream(spark, root), delay=f"{delay} milliseconds"), f"uv{delay}", scratch)
        assert sorted(r.seq for r in got.collect()) == sorted(r.seq for r in unique_visitor(pages).collect())


def test_broken_topic_lines_are_set_aside(spark, scratch):
    root = os.path.join(scratch, "src")
    _files(spark, root, [["no json", _page("a", 0), '{"common": {"mid": "b"}}', '{"ts": 5}'],
                         [_page("z", 86_400_000 * 3, "x")], [_page("z", 86_400_000 * 4, "x")]])
    src = (spark.readStream.schema("value string, seq bigint").option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", "true").parquet(root))
    uv = _run(J.unique_visitor_stream(J.page_log_from_topic(src), delay="1 hour"), "uv_broken", scratch)
    assert [r.seq for r in uv.collect()] == [1]
    bad = _run(J.page_rejects_from_topic(src), "rejects", scratch)
    assert sorted((r.seq, r.reason) for r in bad.collect()) == [(0, "no_mid"), (2, "no_ts"), (3, "no_mid")]
