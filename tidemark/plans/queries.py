"""``queries()`` registry: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each reading whole test tables. Output columns are typed and named
like the oracle SQL in :mod:`tidemark.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.record import field, present
from tidemark.functions.time import (epoch_ms, fmt_date, fmt_datetime, rowtime, to_date, to_ts,
                                     to_ymd_hms)
from tidemark.operators import keyword as kw
from tidemark.operators.dic import code_dictionary, dic_lookup, dic_lookup_asof, dictionary_history, status_code
from tidemark.operators.dim import (config_history, config_rejects, config_state, filter_bootstrap, key_value,
                                    latest_per_key, parse_changes, parse_config_changes, route, route_asof,
                                    route_rejects)
from tidemark.operators.late import counts_on_time, late_rows, with_lateness
from tidemark.operators.split import (TOPIC_ACTION, TOPIC_DISPLAY, TOPIC_ERR,
                                      TOPIC_PAGE, TOPIC_START, topic_counts)
from tidemark.plans import flows as pl
from tidemark.plans import streams
from tidemark.schemas import KEYWORD_BEAN
from tidemark.session import passing_path
from tidemark.sinks.dim import read_dim_table, upsert_dim_tables
from tidemark.sinks.kafka import compacted, from_messages, keyed_changes, to_keyed_messages
from tidemark.sinks.table import sink_columns
from tidemark.sources.fixtures import (DOC_SEQ, ODD_CONFIG, SHARED_SINK, config_changelog, config_changelog_at,
                                       odd_change_log, table)
from tidemark.sources.literal import literal_frame

Query = Callable[[SparkSession, str], DataFrame]


def _size(rec, key) -> F.Column:
    arr = F.try_variant_get(F.col(rec)[key], "$", "array<variant>")
    return F.when(arr.isNotNull(), F.size(arr).cast("bigint"))


def q_parse_log(spark, sf_dir):
    p = pl.parsed_log(spark, sf_dir).filter(F.col("dirty").isNull())
    return p.select(
        "seq", "mid", "is_new", "ts",
        field("rec", "page.page_id").alias("page_id"),
        field("rec", "page.last_page_id").alias("last_page_id"),
        field("rec", "page.item_type").alias("item_type"),
        field("rec", "page.item").alias("item"),
        _size("rec", "displays").alias("n_displays"),
        _size("rec", "actions").alias("n_actions"),
        present("rec", "err").alias("has_err"),
        present("rec", "start").alias("has_start"))


def q_dirty_split(spark, sf_dir):
    p = pl.parsed_log(spark, sf_dir)
    return p.filter(F.col("dirty").isNotNull()).select("seq", F.col("dirty").alias("reason"))


def q_visitor_flag_repair(spark, sf_dir):
    r = pl.repaired_log(spark, sf_dir).filter(F.col("dirty").isNull())
    return r.select("seq", "mid", "ts", "visit_date", "is_new_in", "is_new")


# Topics are read back the way their consumers read them: a typed schema of
# only the fields they use (the JSON reader skips the rest). A nested object
# declared as a string comes back as its JSON text, so it tests presence.
_COMMON = "common struct<mid:string,is_new:string>"


def _topic(spark, sf_dir, topic, schema) -> DataFrame:
    """Records of one topic, read back from their JSON text."""
    r = pl.routed_log(spark, sf_dir, topics=(topic,))
    return r.select("seq", F.from_json("value", schema).alias("r")).select("seq", "r.*")


def _n(arr) -> F.Column:
    return F.when(F.col(arr).isNotNull(), F.size(arr).cast("bigint"))


def q_split_err(spark, sf_dir):
    t = _topic(spark, sf_dir, TOPIC_ERR,
               f"{_COMMON}, ts bigint, err struct<error_code:bigint>, start string, "
               "page struct<page_id:string>, displays array<string>")
    return t.select("seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
                    "ts", F.col("err.error_code").alias("error_code"),
                    F.col("start").isNotNull().alias("has_start"),
                    F.col("page.page_id").alias("page_id"), _n("displays").alias("n_displays"))


def q_split_start(spark, sf_dir):
    t = _topic(spark, sf_dir, TOPIC_START,
               f"{_COMMON}, ts bigint, start struct<entry:string,loading_time:bigint>, err string")
    return t.select("seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
                    "ts", F.col("start.entry").alias("entry"),
                    F.col("start.loading_time").alias("loading_time"),
                    F.col("err").isNotNull().alias("has_err"))


def q_split_page(spark, sf_dir):
    t = _topic(spark, sf_dir, TOPIC_PAGE,
               f"{_COMMON}, ts bigint, page struct<page_id:string,last_page_id:string,"
               "item_type:string,item:string>, err string, displays string, actions string")
    return t.select("seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
                    "ts", "page.page_id", "page.last_page_id", "page.item_type", "page.item",
                    F.col("err").isNotNull().alias("has_err"),
                    F.col("displays").isNotNull().alias("has_displays"),
                    F.col("actions").isNotNull().alias("has_actions"))


def q_split_display(spark, sf_dir):
    t = _topic(spark, sf_dir, TOPIC_DISPLAY,
               f"{_COMMON}, ts bigint, page struct<page_id:string>, display struct<"
               "display_type:string,item:string,order:bigint,pos_id:bigint>")
    return t.select("seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
                    "ts", F.col("page.page_id").alias("page_id"),
                    F.col("display.display_type").alias("display_type"),
                    F.col("display.item").alias("display_item"),
                    F.col("display.order").alias("display_order"),
                    F.col("display.pos_id").alias("pos_id"))


def q_split_action(spark, sf_dir):
    t = _topic(spark, sf_dir, TOPIC_ACTION,
               f"{_COMMON}, ts bigint, page struct<page_id:string>, action struct<"
               "action_id:string,item:string,ts:bigint>")
    return t.select("seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
                    F.col("page.page_id").alias("page_id"),
                    F.col("action.action_id").alias("action_id"),
                    F.col("action.item").alias("action_item"),
                    F.col("action.ts").alias("action_ts"),
                    F.col("ts").isNotNull().alias("has_ts"))


def q_topic_counts(spark, sf_dir):
    return topic_counts(pl.parsed_log(spark, sf_dir))


def q_unique_visitor(spark, sf_dir):
    return pl.unique_visitors(spark, sf_dir, keep=("seq", "is_new", "ts")).select("seq", "mid", "is_new", "ts", "visit_date")


def _jump(within_ms):
    def q(spark, sf_dir):
        j = pl.user_jumps(spark, sf_dir, within_ms)
        return j.select("seq", "mid", "is_new", "ts",
                        F.try_element_at("page", F.lit("last_page_id")).alias("last_page_id"))
    return q


def q_keyword_filter(spark, sf_dir):
    s = kw.keyword_filter(pl.page_log(spark, sf_dir, repaired=False))
    return s.select("fullword", fmt_datetime("rowtime").alias("rowtime"))


def q_keyword_explode(spark, sf_dir):
    s = kw.keyword_explode(kw.keyword_filter(pl.page_log(spark, sf_dir, repaired=False)))
    return s.select("keyword", fmt_datetime("rowtime").alias("rowtime"))


def _kw_window(duration):
    def q(spark, sf_dir):
        return pl.keyword_page_view_window(spark, sf_dir, duration, with_ts=False)
    return q


def q_dim_filter_bootstrap(spark, sf_dir):
    c = filter_bootstrap(pl.dim_changes(spark, sf_dir))
    return c.select("seq", F.col("table").alias("source_table"), "type")


def _routed_keys(spark, sf_dir):
    return pl.dim_routed(spark, sf_dir).withColumn("row_key", key_value())


def q_dim_route(spark, sf_dir):
    r = _routed_keys(spark, sf_dir)
    return r.select("seq", F.col("table").alias("source_table"), "type", "sink_table", "row_key")


def q_dim_prune_columns(spark, sf_dir):
    r = _routed_keys(spark, sf_dir)
    e = r.select("sink_table", "seq", "row_key", F.explode("data").alias("column_name", "v"))
    val = F.coalesce(F.try_variant_get("v", "$", "string"), F.to_json("v"))
    return e.select("sink_table", "seq", "row_key", "column_name", val.alias("column_value"))


def _upsert(apply_deletes):
    def q(spark, sf_dir):
        last = latest_per_key(pl.dim_routed(spark, sf_dir), apply_deletes=apply_deletes)
        val = F.coalesce(F.try_variant_get("v", "$", "string"), F.to_json("v"))
        return (last.select("sink_table", "row_key", "seq", "type", F.explode("data").alias("column_name", "v"))
                    .select("sink_table", "row_key", "seq", "type", "column_name", val.alias("column_value")))
    return q


def q_dim_route_asof(spark, sf_dir):
    """Each change by the config of its own position: lost before its table has
    one or while it is deleted, pruned to the columns of that time."""
    r = route_asof(pl.dim_changes(spark, sf_dir), config_history(parse_config_changes(config_changelog_at(spark))))
    return r.select("seq", F.col("table").alias("source_table"), "type", "sink_table",
                    key_value().alias("row_key"), F.concat_ws(",", F.array_sort(F.map_keys("data"))).alias("columns"))


def _routed_once(spark, sf_dir, state) -> DataFrame:
    """The routed changes, parsed once and written, for queries of several batches."""
    path = passing_path(spark, f"routed-{uuid.uuid4().hex}")
    route(pl.dim_changes(spark, sf_dir), state).write.parquet(path)
    return spark.read.parquet(path)


def _table_values(spark, root, tables) -> DataFrame:
    """``(sink_table, row_key, column_name, column_value)`` of dimension tables."""
    parts = []
    for t in tables:
        rows = read_dim_table(spark, root, t)
        cols = [c for c in rows.columns if c != "row_key"]
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("column_value")) for c in cols])
        parts.append(rows.select(F.lit(t).alias("sink_table"), "row_key", F.inline(pairs)))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def q_dim_table_rows(spark, sf_dir):
    """The dimension tables after three batches that overlap in time: each
    change's ``seq`` is its source time, and batches take every third."""
    state = pl.dim_config(spark)
    routed = _routed_once(spark, sf_dir, state).withColumn("src_ts", F.col("seq"))
    root = passing_path(spark, f"dim-{uuid.uuid4().hex}")
    for run_no, third in enumerate((1, 2, 0)):
        tables = upsert_dim_tables(routed.filter(F.pmod("seq", F.lit(3)) == third), state, root, run_no)
    return _table_values(spark, root, tables)


def q_dim_shared_sink(spark, sf_dir):
    """Customers and orders feed one table, column by column, in two batches (odd
    positions, then even); the second batch's config has a column more."""
    root = passing_path(spark, f"dim-{uuid.uuid4().hex}")
    for run_no, config in enumerate(SHARED_SINK):
        state = config_state(parse_config_changes(config_changelog(spark, config)))
        routed = route(pl.dim_changes(spark, sf_dir), state).withColumn("src_ts", F.col("seq"))
        upsert_dim_tables(routed.filter(F.pmod("seq", F.lit(2)) == 1 - run_no), state, root, run_no)
    return _table_values(spark, root, ["dim_buyer"])


def _odd(spark, sf_dir):
    state = config_state(parse_config_changes(config_changelog(spark, ODD_CONFIG)))
    return parse_changes(odd_change_log(spark, sf_dir)), state


def q_dim_odd_values(spark, sf_dir):
    """Apostrophes and nulls reach the table as they are; changes without data don't stop the batch."""
    changes, state = _odd(spark, sf_dir)
    root = passing_path(spark, f"dim-{uuid.uuid4().hex}")
    upsert_dim_tables(route(changes, state), state, root)
    return _table_values(spark, root, ["dim_vendor"])


def q_dim_rejects(spark, sf_dir):
    """What is set aside: changes without data, broken lines, a config without its key."""
    changes, state = _odd(spark, sf_dir)
    bad = config_rejects(state).select(F.lit(None).cast("bigint").alias("seq"), F.col("source_table").alias("table"),
                                       F.lit(None).cast("string").alias("type"), F.lit("bad_key").alias("reason"))
    return route_rejects(changes, state).unionByName(bad).withColumnRenamed("table", "source_table")


def _lateness(spark, sf_dir):
    return with_lateness(pl.page_log(spark, sf_dir, repaired=False))


def q_keyword_late_rows(spark, sf_dir):
    return late_rows(_lateness(spark, sf_dir))


def q_keyword_on_time(spark, sf_dir):
    return counts_on_time(_lateness(spark, sf_dir))


_KEYWORD_KEY = ["stt", "edt", "source", "keyword"]


def _keyword_versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Daily keyword counts of the lines before the documents' arrive, and of
    all lines without the events of the first ten days (kept no longer)."""
    path = passing_path(spark, f"searches-{uuid.uuid4().hex}")
    page = pl.page_log(spark, sf_dir, repaired=False)
    kw.keyword_filter(page.withColumn("rowtime", F.struct(rowtime("ts").alias("t"), F.col("seq")))).write.parquet(path)
    found = spark.read.parquet(path).select("fullword", "rowtime.t", "rowtime.seq").withColumnRenamed("t", "rowtime")
    count = lambda rows: kw.keyword_window(kw.keyword_explode(kw.dealt(rows)), "1 day", with_ts=False)
    old = count(found.filter(F.col("seq") < DOC_SEQ))
    kept = (F.col("seq") >= DOC_SEQ) | (F.col("rowtime") >= F.lit("2024-01-11").cast("timestamp_ntz"))
    return old, count(found.filter(kept))


def _key_fields(key: str = "key"):
    return F.from_json(key, "stt string, edt string, source string, keyword string").alias("k")


def q_keyed_changes(spark, sf_dir):
    """The messages between two versions of the daily counts; a tombstone has
    no count."""
    m = keyed_changes(*_keyword_versions(spark, sf_dir), _KEYWORD_KEY)
    return m.select(_key_fields(), F.from_json("value", "keyword_count bigint").alias("v")).select("k.*", "v.keyword_count")


def q_keyed_replay(spark, sf_dir):
    """The older version as messages, then the changes, compacted: the newer one."""
    old, new = _keyword_versions(spark, sf_dir)
    log = (to_keyed_messages(old, _KEYWORD_KEY).withColumn("seq", F.lit(0))
           .unionByName(keyed_changes(old, new, _KEYWORD_KEY).withColumn("seq", F.lit(1))))
    return from_messages(compacted(log), new.schema)


def q_dic_lookup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", status_code("o_orderstatus").alias("dic_code"))
    return dic_lookup(o, code_dictionary(spark))


# Fixed test changes of the dictionary: (position in days since 1970, code, name, parent).
_DIC_CHANGES = ((0, "1001", "unpaid", "10"), (0, "1004", "finished", "10"), (10_000, "1004", "done", "10"),
                (10_500, "1001", "awaiting payment", "10"), (10_700, "1004", None, "10"), (10_900, "1004", "closed", "10"),
                (9_800, "1002", "paid", "10"))


def q_dic_lookup_asof(spark, sf_dir):
    """Orders by a dictionary that changes, through a copy refreshed every 30 days."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", status_code("o_orderstatus").alias("dic_code"),
        F.unix_date(F.to_date("o_orderdate")).cast("bigint").alias("day"))
    h = dictionary_history(literal_frame(spark, list(_DIC_CHANGES), "at bigint, dic_code string, dic_name string, parent_code string"))
    return dic_lookup_asof(o, h, "day", ttl=30)


def q_fn_to_date(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"),
                                                epoch_ms("ts").alias("ts"))
    return e.select("seq", "ts", to_date("ts").alias("date_utc"),
                    to_ymd_hms("ts").alias("ymd_hms_utc"),
                    to_date("ts", "Asia/Shanghai").alias("date_cst"))


def q_fn_to_ts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", fmt_date("o_orderdate").alias("order_date"))
    return o.select("o_orderkey", "order_date", to_ts("order_date").alias("ts_ms"),
                    to_ts(F.concat("order_date", F.lit(" 12:34:56")), is_full=True).alias("ts_ms_full"))


def q_keyed_messages(spark, sf_dir):
    w = pl.keyword_page_view_window(spark, sf_dir, "1 day", with_ts=False)
    m = to_keyed_messages(w, ["stt", "edt", "source", "keyword"])
    k = F.from_json("key", "stt string, edt string, source string, keyword string")
    v = F.from_json("value", "keyword_count bigint")
    return m.select(k.alias("k"), v.alias("v")).select("k.*", "v.keyword_count")


def q_sink_columns(spark, sf_dir):
    w = pl.keyword_page_view_window(spark, sf_dir, "1 day", with_ts=True)
    return sink_columns(w, KEYWORD_BEAN.fieldNames(), transient=("ts",))


def q_keyword_window_sql(spark, sf_dir):
    return kw.keyword_counts_sql(pl.page_log(spark, sf_dir, repaired=False), "10 seconds")


def queries() -> dict[str, Query]:
    return {
        "parse_log": q_parse_log,
        "dirty_split": q_dirty_split,
        "visitor_flag_repair": q_visitor_flag_repair,
        "split_err": q_split_err,
        "split_start": q_split_start,
        "split_page": q_split_page,
        "split_display": q_split_display,
        "split_action": q_split_action,
        "topic_counts": q_topic_counts,
        "unique_visitor": q_unique_visitor,
        "user_jump": _jump(10_000),
        "user_jump_6h": _jump(6 * 3600 * 1000),
        "keyword_filter": q_keyword_filter,
        "keyword_explode": q_keyword_explode,
        "keyword_window": _kw_window("10 seconds"),
        "keyword_window_1d": _kw_window("1 day"),
        "keyword_window_sql": q_keyword_window_sql,
        "dim_filter_bootstrap": q_dim_filter_bootstrap,
        "dim_route": q_dim_route,
        "dim_prune_columns": q_dim_prune_columns,
        "dim_upsert_latest": _upsert(False),
        "dim_upsert_deletes": _upsert(True),
        "dim_table_rows": q_dim_table_rows,
        "dim_route_asof": q_dim_route_asof,
        "dim_shared_sink": q_dim_shared_sink,
        "dim_odd_values": q_dim_odd_values,
        "dim_rejects": q_dim_rejects,
        "dic_lookup": q_dic_lookup,
        "dic_lookup_asof": q_dic_lookup_asof,
        "fn_to_date": q_fn_to_date,
        "fn_to_ts": q_fn_to_ts,
        "keyed_messages": q_keyed_messages,
        "keyed_changes": q_keyed_changes,
        "keyed_replay": q_keyed_replay,
        "keyword_late_rows": q_keyword_late_rows,
        "keyword_on_time": q_keyword_on_time,
        "sink_columns": q_sink_columns,
        "stream_flag_repair": streams.flag_repair,
        "stream_unique_visitor": streams.unique_visitor,
        "stream_user_jump": streams.user_jump,
        "stream_keyword_window": streams.keyword_window,
    }
