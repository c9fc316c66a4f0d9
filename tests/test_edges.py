"""Hand-made edge tables (FIXTURES.md part C)."""

import json

from pyspark.sql import functions as F

from helpers import D1, DAY, by_seq, log_line, pages, parse_values, parsed, seqs
from tidemark.functions.text import tokens
from tidemark.operators.bounce import user_jump
from tidemark.operators.dim import (config_rejects, config_state, latest_per_key,
                                    parse_changes, parse_config_changes, route,
                                    table_ddl, table_schema)
from tidemark.operators.keyword import keyword_counts
from tidemark.operators.parse import dirty_split
from tidemark.operators.split import fan_out
from tidemark.operators.unique import unique_visitor
from tidemark.operators.visitor import visitor_flag_repair
from tidemark.sources.logs import from_rows


def test_c1_visitor_flag(spark):
    h = 3600_000
    lines = [  # arrival order = list order = (ts, seq) order per device
        log_line("a", D1 + h, "1"), log_line("a", D1 + 2 * h, "1"), log_line("a", D1 + DAY, "1"),
        log_line("b", D1 + DAY, "0"), log_line("b", D1 + DAY + h, "1"),
        log_line("c", D1 + DAY, "0"), log_line("c", D1 + DAY + h, "1"),
        log_line("d", D1 + DAY, None), log_line("d", D1 + DAY + h, "1"),
        log_line("e", D1, "1"), log_line("e", D1 + DAY, "0"), log_line("e", D1 + DAY + h, "1"),
    ]
    out = by_seq(visitor_flag_repair(parsed(spark, lines)), "is_new")
    assert [out[i] for i in range(12)] == [
        "1", "1", "0", "0", "0", "0", "0", None, "0", "1", "0", "0"]
    # C1 row c: the anchor written by a not-new record is the day before, so a
    # later new record dated that day keeps its flag (arrival order = ts, seq).
    lines2 = [log_line("c", D1 + DAY, "0"), log_line("c", D1 + 2 * DAY, "1"),
              log_line("c", D1 + DAY + h, "1")]
    df = visitor_flag_repair(parsed(spark, lines2))
    assert by_seq(df, "is_new") == {0: "0", 1: "0", 2: "0"}
    lines3 = [log_line("x", D1 + DAY, "0")] + [log_line("x", D1 + 2 * DAY - 1, "1")]
    assert by_seq(visitor_flag_repair(parsed(spark, lines3)), "is_new") == {0: "0", 1: "0"}


def test_c1_rec_is_rewritten(spark):
    lines = [log_line("a", D1, "1"), log_line("a", D1 + DAY, "1")]
    df = fan_out(visitor_flag_repair(parsed(spark, lines)))
    page = {r["seq"]: json.loads(r["value"]) for r in
            df.filter(F.col("topic") == "dwd_traffic_page_log").collect()}
    assert page[0]["common"]["is_new"] == "1"
    assert page[1]["common"]["is_new"] == "0"


def test_c2_unique_visitor(spark):
    h = 3600_000
    lines = [
        log_line("a", D1, last_page_id=None), log_line("a", D1 + h), log_line("a", D1 + DAY),
        log_line("b", D1, last_page_id="home"), log_line("b", D1 + h),
        log_line("c", D1, last_page_id=""),
        log_line("d", D1), log_line("d", D1 + DAY),
    ]
    assert seqs(unique_visitor(pages(spark, lines))) == [0, 2, 4, 6, 7]


def test_c3_bounce(spark):
    s = 1000
    lines = [
        log_line("a", 10 * s, last_page_id=None),
        log_line("b", 12 * s), log_line("b", 15 * s, last_page_id="home"),
        log_line("c", 12 * s), log_line("c", 30 * s, last_page_id="home"),
        log_line("d", 31 * s), log_line("d", 32 * s),
        log_line("e", 0), log_line("e", 10 * s, last_page_id="home"),
        log_line("f", 0), log_line("f", 9999, last_page_id="home"),
        log_line("g", 5 * s, last_page_id="detail"),
        log_line("h", 0, last_page_id=""), log_line("h", 1 * s),
    ]
    got = seqs(user_jump(pages(spark, lines), 10_000))
    assert got == [0, 3, 5, 6, 7, 12, 13]
    # bucket width must not matter
    assert seqs(user_jump(pages(spark, lines), 10_000, bucket_factor=1)) == got
    assert seqs(user_jump(pages(spark, lines), 10_000, bucket_factor=50)) == got


def _cfg(spark, changes):
    rows = [(json.dumps({"op": op, "before": b, "after": a}), i) for i, (op, b, a) in enumerate(changes)]
    return parse_config_changes(spark.createDataFrame(rows, "value string, seq bigint"))


def _tp(src, sink, cols="id,name", pk="id"):
    return {"source_table": src, "sink_table": sink, "sink_columns": cols, "sink_pk": pk,
            "sink_extend": None}


def _state(df):
    return {r["source_table"]: r["sink_table"] for r in df.collect()}


def test_c4_config_fold(spark):
    assert _state(config_state(_cfg(spark, [("r", None, _tp("a", "x")), ("u", _tp("a", "x"), _tp("a", "y"))]))) == {"a": "y"}
    assert _state(config_state(_cfg(spark, [("r", None, _tp("a", "x")), ("d", _tp("a", "x"), None)]))) == {}
    assert _state(config_state(_cfg(spark, [("d", _tp("a", "x"), None), ("c", None, _tp("a", "z"))]))) == {"a": "z"}
    st = config_state(_cfg(spark, [("c", None, _tp("a", "x", "id,name", None))])).collect()[0]
    assert st["pk"] == "id" and st["valid"] and st["ext"] == ""
    bad = config_state(_cfg(spark, [("c", None, _tp("a", "x", "a,b", None))]))
    assert config_rejects(bad).count() == 1
    ren = [("r", None, _tp("a", "x")), ("u", _tp("a", "x"), _tp("b", "y"))]
    assert _state(config_state(_cfg(spark, ren))) == {"a": "x", "b": "y"}
    assert _state(config_state(_cfg(spark, ren), retire_renamed=True)) == {"b": "y"}


def test_k4_schema_and_ddl(spark):
    st = config_state(_cfg(spark, [("c", None, _tp("a", "dim_a", "id,name,logo", None))]))
    rows = [(r["position"], r["column_name"], r["is_pk"]) for r in table_schema(st).orderBy("position").collect()]
    assert rows == [(0, "id", True), (1, "name", False), (2, "logo", False)]
    ddl = table_ddl(st).collect()[0]["ddl"]
    assert ddl == ("CREATE TABLE IF NOT EXISTS dim.dim_a (`id` STRING NOT NULL, `name` STRING, "
                   "`logo` STRING) USING parquet")


def test_c5_dirty(spark):
    lines = ['{"a":1}', "{bad", "", None, "123", "[1]", "null",
             '{"common":{"mid":"1"},"ts":1} junk', '{"common":{"mid":"1"}}',
             '{"common":{"mid":"1"},"ts":5}']
    good, dirty = dirty_split(parsed(spark, lines))
    # text after one complete object is accepted (documented in FIXTURES C5)
    assert seqs(good) == [7, 9]
    reasons = by_seq(dirty, "dirty")
    assert reasons[0] == "no_mid" and reasons[8] == "no_ts"
    assert all(reasons[i] == "unparsable" for i in range(1, 7))


def test_c6_routing(spark):
    disp = [{"item": "1"}, {"item": "2"}]
    lines = [
        log_line("m", 1, err={"code": 1}),                                   # err + page
        log_line("m", 2, page=False, err={"code": 2}, start={"entry": "i"}),  # err + start
        log_line("m", 3, page=False, start={"entry": "i"}, displays=disp),   # start only
        log_line("m", 4, page=False),                                        # page (no page)
        log_line("m", 5, displays=[]),                                       # page only
        log_line("m", 6, displays=disp, actions=[{"action_id": "x"}]),        # page+2 disp+1 act
    ]
    out = fan_out(visitor_flag_repair(parsed(spark, lines)))
    got = sorted((r["seq"], r["topic"]) for r in out.collect())
    t = {"e": "dwd_traffic_err_log", "s": "dwd_traffic_start_log", "p": "dwd_traffic_page_log",
         "d": "dwd_traffic_display_log", "a": "dwd_traffic_action_log"}
    want = sorted([(0, t["e"]), (0, t["p"]), (1, t["e"]), (1, t["s"]), (2, t["s"]), (3, t["p"]),
                   (4, t["p"]), (5, t["p"]), (5, t["d"]), (5, t["d"]), (5, t["a"])])
    assert got == want
    vals = {(r["seq"], r["topic"]): json.loads(r["value"]) for r in out.collect()
            if r["topic"] in (t["p"], t["s"], t["a"])}
    assert "err" not in vals[(0, t["p"])] and "err" not in vals[(1, t["s"])]
    assert "displays" not in vals[(5, t["p"])] and "actions" not in vals[(5, t["p"])]
    assert "ts" not in vals[(5, t["a"])] and vals[(5, t["a"])]["action"] == {"action_id": "x"}
    disp_vals = [json.loads(r["value"]) for r in out.filter(F.col("topic") == t["d"]).collect()]
    assert sorted(v["display"]["item"] for v in disp_vals) == ["1", "2"]
    assert all(v["ts"] == 6 for v in disp_vals)


def test_c7_pruning(spark):
    change = json.dumps({"table": "t", "type": "insert",
                         "data": {"id": 1, "name": "n", "logo": "l", "nest": {"x": [1, 2]}}})
    ch = parse_changes(from_rows(spark, [change]))
    for cols, keys in (("id,name", ["id", "name"]), ("id, name", ["id"]),
                       ("id,nest,missing", ["id", "nest"])):
        st = config_state(_cfg(spark, [("c", None, _tp("t", "dim_t", cols))]))
        r = route(ch, st).collect()[0]
        assert sorted(r["data"].keys()) == keys
        assert r["sink_table"] == "dim_t"
    st = config_state(_cfg(spark, [("c", None, _tp("t", "dim_t", "id,nest"))]))
    data = route(ch, st).select(F.to_json("data").alias("j")).collect()[0]["j"]
    assert json.loads(data)["nest"] == {"x": [1, 2]}


def test_q1_latest_and_deletes(spark):
    mk = lambda typ, id_, v: json.dumps({"table": "t", "type": typ, "data": {"id": id_, "v": v}})
    ch = parse_changes(from_rows(spark, [mk("insert", 1, "a"), mk("update", 1, "b"), mk("delete", 1, "b"),
                                          mk("insert", 2, "c"), mk("bootstrap-start", 3, "z")]))
    st = config_state(_cfg(spark, [("c", None, _tp("t", "dim_t", "id,v"))]))
    last = {r["row_key"]: r["type"] for r in latest_per_key(route(ch, st)).collect()}
    assert last == {"1": "delete", "2": "insert"}
    kept = {r["row_key"] for r in latest_per_key(route(ch, st), apply_deletes=True).collect()}
    assert kept == {"2"}


def test_c8_keyword_window(spark):
    def page(ts, lp, item, it="keyword"):
        return json.dumps({"common": {"mid": "m"}, "ts": ts,
                           "page": {"last_page_id": lp, "item": item, "item_type": it}})
    lines = [page(9_999, "search", "Red red"), page(10_000, "search", "red"),
             page(11_000, "search", "!!"), page(12_000, "home", "red"),
             page(13_000, "search", "red", "sku_id"),
             json.dumps({"common": {"mid": "m"}, "ts": 14_000,
                         "page": {"last_page_id": "search", "item_type": "keyword"}})]
    got = sorted((r["stt"], r["keyword"], r["keyword_count"])
                 for r in keyword_counts(pages(spark, lines), with_ts=False).collect())
    assert got == [("1970-01-01 00:00:00", "red", 2), ("1970-01-01 00:00:10", "red", 1)]


def test_tokens_whole_text(spark):
    text = "Alpha beta " * 5000 + "ÉTÉ 42"
    df = spark.createDataFrame([(text,)], "t string")
    toks = df.select(tokens("t").alias("x")).collect()[0]["x"]
    assert len(toks) == 10002 and toks[-2:] == ["été", "42"]


def test_q2_route_rejects(spark):
    from tidemark.operators.dim import route_rejects
    lines = [json.dumps({"table": "t", "type": "insert", "data": {"id": 1}}),
             json.dumps({"table": "t", "type": "insert"}),
             json.dumps({"table": "t", "type": "insert", "data": None}),
             json.dumps({"table": "other", "type": "insert"}),
             "{broken"]
    ch = parse_changes(from_rows(spark, lines))
    st = config_state(_cfg(spark, [("c", None, _tp("t", "dim_t", "id"))]))
    assert route(ch, st).count() == 1
    got = sorted((r["seq"], r["reason"]) for r in route_rejects(ch, st).collect())
    assert got == [(1, "no_data"), (2, "no_data"), (4, "unparsable")]


def test_p11_actions_with_time_on_demand(spark):
    from tidemark.operators.split import TOPIC_ACTION, fan_out
    from tidemark.operators.visitor import visitor_flag_repair
    line = log_line("m", D1, "0", actions=[{"action_id": "a"}])
    df = visitor_flag_repair(parsed(spark, [line]))
    for with_ts in (False, True):
        (v,) = parse_values(fan_out(df, (TOPIC_ACTION,), with_ts=with_ts))
        assert v["action"] == {"action_id": "a"} and (v.get("ts") == D1) == with_ts
