"""Test sources derived from the driver's parquet tables.

The reference consumes JSON behaviour logs and change records from Kafka;
here the same shapes are derived from ``events``/``documents`` and the
dimension tables with plain expressions that DuckDB can repeat (mapping in
FIXTURES.md). Everything is lazy and scales with the input tables: each event
becomes one log line, each document two, each dimension row one change record.
"""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.time import epoch_ms, fmt_date
from tidemark.sources.literal import literal_frame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Lines derived from documents arrive after all events, broken lines after both.
DOC_SEQ, DIRTY_SEQ = 1 << 40, 1 << 41
DOC_TS = 1_704_067_200_000


def _event_attrs(events: DataFrame) -> DataFrame:
    """Per-event attributes of the log line (rules B1 in FIXTURES.md)."""
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    et = F.col("event_type")
    item_type = F.when(eid % 2 == 0, F.lit("keyword")).otherwise(F.lit("sku_id"))
    return events.select(
        eid.alias("seq"),
        F.col("user_id").cast("string").alias("mid"),
        epoch_ms("ts").alias("ts_ms"),
        et.alias("event_type"),
        k.alias("k"),
        F.when(eid % 3 == 0, F.lit("1")).when(eid % 3 == 1, F.lit("0")).alias("is_new"),
        (et == "error").alias("has_err"),
        ((et == "signup") | ((et == "error") & (eid % 4 == 0))).alias("has_start"),
        F.when(eid % 5 == 2, F.lit("")).when(eid % 5 == 3, F.lit("home"))
         .when(eid % 5 == 4, F.lit("search")).alias("last_page_id"),
        item_type.alias("item_type"),
        F.when(eid % 7 != 0, F.when(item_type == "keyword", F.concat_ws(" ", et, k.cast("string")))
         .otherwise(k.cast("string"))).alias("item"),
        (eid % 50 == 0).alias("is_dirty"),
    )


def _document_attrs(docs: DataFrame) -> DataFrame:
    """Two lines per document (rules B2): its own device starts a visit and,
    3 s (even ids) or 20 s (odd ids) later, searches for the whole text."""
    did = F.col("doc_id")
    ts = F.lit(DOC_TS) + did % 86400 * 1000
    gap = F.when(did % 2 == 0, F.lit(3000)).otherwise(F.lit(20000))
    null = F.lit(None).cast("string")

    def line(n, at, event_type, is_new, last_page, item_type, item):
        return F.struct((F.lit(DOC_SEQ) + did * 2 + n).alias("seq"), at.alias("ts_ms"),
                        F.lit(event_type).alias("event_type"), F.lit(is_new).alias("is_new"),
                        last_page.alias("last_page_id"), item_type.alias("item_type"), item.alias("item"))

    lines = F.array(line(0, ts, "home", "1", null, null, null),
                    line(1, ts + gap, "good_list", "0", F.lit("search"), F.lit("keyword"), F.col("text")))
    no = F.lit(False)
    return (docs.select(F.concat(F.lit("doc"), did.cast("string")).alias("mid"), (did % 100).alias("k"),
                        F.inline(lines))
            .select("seq", "mid", "ts_ms", "event_type", "k", "is_new", no.alias("has_err"), no.alias("has_start"),
                    "last_page_id", "item_type", "item", no.alias("is_dirty")))


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value STRING, seq BIGINT)``: one JSON log line per event, two per
    document, and one broken line beside every 50th event.

    ``seq`` plays the part of the source offset (arrival order). Every
    document is searched for once, by its whole text. No join. A few MB of events are many
    lines to build and parse: they are dealt evenly, as a file split holds too many for one task.
    """
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    ev = _event_attrs(events.hint("rebalance", "event_id")).unionByName(
        _document_attrs(table(spark, sf_dir, "documents").select("doc_id", "text")))

    k = F.col("k")
    ts = F.col("ts_ms")
    is_page = ~F.col("has_start")
    common = F.struct(F.col("mid").alias("mid"), F.col("is_new").alias("is_new"),
                      F.col("mid").alias("uid"), F.lit("web").alias("ch"))
    page = F.struct(
        F.col("event_type").alias("page_id"),
        F.col("last_page_id").alias("last_page_id"),
        F.col("item").alias("item"),
        F.col("item_type").alias("item_type"),
        (k * 100).alias("during_time"),
    )
    start = F.struct(
        F.element_at(F.array(F.lit("icon"), F.lit("notice"), F.lit("install")),
                     (k % 3 + 1).cast("int")).alias("entry"),
        (k * 10).alias("loading_time"),
        k.alias("open_ad_id"),
    )
    err = F.struct((k + 1000).alias("error_code"),
                   F.concat(F.lit("E"), k.cast("string")).alias("msg"))
    n_disp = (k % 4).cast("int")
    displays = F.transform(
        F.array_repeat(F.lit(0), n_disp),
        lambda _, i: F.struct(
            F.when(i % 2 == 0, F.lit("promotion")).otherwise(F.lit("recommend")).alias("display_type"),
            (k * 10 + i).cast("string").alias("item"),
            F.lit("sku_id").alias("item_type"),
            (i + 1).cast("bigint").alias("order"),
            ((k + i) % 5).alias("pos_id"),
        ))
    n_act = F.when(F.col("event_type") == "purchase", k % 3).otherwise(0).cast("int")
    actions = F.transform(
        F.array_repeat(F.lit(0), n_act),
        lambda _, i: F.struct(
            F.when(i == 0, F.lit("cart_add")).otherwise(F.lit("favor_add")).alias("action_id"),
            (k * 10 + i).cast("string").alias("item"),
            F.lit("sku_id").alias("item_type"),
            (ts + (i + 1) * 1000).alias("ts"),
        ))
    rec = F.struct(
        common.alias("common"),
        F.when(is_page, page).alias("page"),
        F.when(F.col("has_start"), start).alias("start"),
        F.when(F.col("has_err"), err).alias("err"),
        F.when(is_page, displays).alias("displays"),
        F.when(is_page & (F.col("event_type") == "purchase"), actions).alias("actions"),
        ts.alias("ts"),
    )
    # A broken line beside the good one: its text behind a stray character.
    out = ev.select(F.to_json(rec).alias("v"), "seq", "is_dirty")
    good = F.struct(F.col("v").alias("value"), F.col("seq").alias("seq"))
    broken = F.struct(F.concat(F.lit("}"), F.col("v")).alias("value"), (F.lit(DIRTY_SEQ) + F.col("seq")).alias("seq"))
    return out.select(F.inline(F.when(F.col("is_dirty"), F.array(good, broken)).otherwise(F.array(good))))


# Dimension tables turned into change records: (table, key column, columns).
DIM_SOURCES = (
    ("customer", "c_custkey", ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
    ("part", "p_partkey", ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")),
    ("supplier", "s_suppkey", ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")),
    ("nation", "n_nationkey", ("n_nationkey", "n_name", "n_regionkey")),
)
MARKER_START_SEQ = -1
MARKER_END_SEQ = 1 << 62
ORDER_SEQ_DAY = 10 ** 12


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business change records ``(value, seq)`` as a binlog reader emits them:
    every row of customer, part, supplier and nation as an ``insert`` (seq =
    the row key), one ``bootstrap-start`` and one ``bootstrap-complete``
    marker per table, and every order as an ``update`` (``delete`` when
    ``o_orderkey % 10 = 0``) of table ``orders``, arriving in
    (o_orderdate, o_orderkey) order."""
    parts = []
    for name, key, cols in DIM_SOURCES:
        t = table(spark, sf_dir, name)
        data = F.struct(*[F.col(c) for c in cols])
        rec = F.struct(F.lit("shop").alias("database"), F.lit(name).alias("table"),
                       F.lit("insert").alias("type"), data.alias("data"))
        parts.append(t.select(F.to_json(rec).alias("value"), F.col(key).cast("bigint").alias("seq")))
    # Markers carry no row data: one start and one end per table.
    import json
    markers = [(json.dumps({"database": "shop", "table": name, "type": typ}), seq)
               for name, _, _ in DIM_SOURCES
               for typ, seq in (("bootstrap-start", MARKER_START_SEQ),
                                ("bootstrap-complete", MARKER_END_SEQ))]
    parts.append(literal_frame(spark, markers, "value string, seq bigint"))
    o = table(spark, sf_dir, "orders")
    odata = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                     fmt_date("o_orderdate").alias("o_orderdate"))
    otype = F.when(F.col("o_orderkey") % 10 == 0, F.lit("delete")).otherwise(F.lit("update"))
    orec = F.struct(F.lit("shop").alias("database"), F.lit("orders").alias("table"),
                    otype.alias("type"), odata.alias("data"))
    oseq = (F.unix_date(F.to_date("o_orderdate")).cast("bigint") * F.lit(ORDER_SEQ_DAY)
            + F.col("o_orderkey"))
    parts.append(o.select(F.to_json(orec).alias("value"), oseq.alias("seq")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _tp(src, sink, cols, pk, ext=None):
    return {"source_table": src, "sink_table": sink, "sink_columns": cols,
            "sink_pk": pk, "sink_extend": ext}


# Fixed test config changelog, in arrival order (S3 envelopes r/c/u/d).
CONFIG_CHANGES = (
    ("r", None, _tp("customer", "dim_customer", "c_custkey,c_name", "c_custkey")),
    ("c", None, _tp("part", "dim_part", "p_partkey,p_name,p_brand", "p_partkey")),
    ("u", _tp("customer", "dim_customer", "c_custkey,c_name", "c_custkey"),
     _tp("customer", "dim_customer", "c_custkey,c_name,c_mktsegment", "c_custkey")),
    ("c", None, _tp("supplier", "dim_supplier", "s_suppkey,s_name", "s_suppkey")),
    ("d", _tp("supplier", "dim_supplier", "s_suppkey,s_name", "s_suppkey"), None),
    ("c", None, _tp("orders", "dim_customer_last_order",
                    "o_custkey,o_orderkey,o_orderstatus,o_orderdate", "o_custkey")),
)


def odd_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes ``(value, seq)`` of every supplier as table ``vendor``, with what breaks
    writers: by ``s_suppkey % 5`` no ``data`` (0), a name with an apostrophe (1), a null balance (2),
    broken text (3), and as they are (4). Another table's config has a key that is
    none of its columns (:data:`ODD_CONFIG`)."""
    s = table(spark, sf_dir, "supplier")
    n = F.col("s_suppkey") % 5
    data = F.to_json(F.struct("s_suppkey", F.when(n == 1, F.concat(F.lit("O'"), "s_name")).otherwise(F.col("s_name")).alias("s_name"),
                              "s_acctbal"))
    # a field that is there with null, which to_json would leave out
    data = F.when(n == 2, F.regexp_replace(data, r'"s_acctbal":[^,}]*', '"s_acctbal":null')).otherwise(data)
    head = F.lit('{"database":"shop","table":"vendor","type":"update"')
    value = F.when(n == 0, F.concat(head, F.lit("}"))).when(n == 3, F.concat(head, F.lit(',"data":'))).otherwise(
        F.concat(head, F.lit(',"data":'), data, F.lit("}")))
    return s.select(value.alias("value"), F.col("s_suppkey").cast("bigint").alias("seq"))


ODD_CONFIG = (
    ("c", None, {"source_table": "vendor", "sink_table": "dim_vendor", "sink_columns": "s_suppkey,s_name,s_acctbal",
                 "sink_pk": "s_suppkey", "sink_extend": None}),
    ("c", None, {"source_table": "lost", "sink_table": "dim_lost", "sink_columns": "name", "sink_pk": None, "sink_extend": None}),
)


def _day(iso: str) -> int:
    """Position of a day's first order."""
    return (date.fromisoformat(iso) - date(1970, 1, 1)).days * ORDER_SEQ_DAY


_ORDERS_1 = _tp("orders", "dim_order", "o_orderkey,o_custkey", "o_orderkey")
_ORDERS_2 = _tp("orders", "dim_order", "o_orderkey,o_custkey,o_orderstatus", "o_orderkey")
_ORDERS_3 = _tp("orders", "dim_order_late", "o_orderkey,o_orderdate", "o_orderkey")
_CUST_1 = _tp("customer", "dim_customer", "c_custkey,c_name", "c_custkey")
_CUST_2 = _tp("customer", "dim_customer", "c_custkey,c_name,c_mktsegment", "c_custkey")

# Fixed test config changelog amid the changes: (position, op, before, after). Orders get
# their config in 1996, another column in 1998, lose it in 1999 and come back under another
# table in 2000; customers have one from key 10, another from key 70; nations from key 10.
CONFIG_HISTORY = (
    (10, "c", None, _CUST_1),
    (70, "u", _CUST_1, _CUST_2),
    (10, "r", None, _tp("nation", "dim_nation", "n_nationkey,n_name", "n_nationkey")),
    (_day("1996-01-01"), "c", None, _ORDERS_1),
    (_day("1998-01-01"), "u", _ORDERS_1, _ORDERS_2),
    (_day("1999-01-01"), "d", _ORDERS_2, None),
    (_day("2000-01-01"), "c", None, _ORDERS_3),
)

# Two source tables that feed one sink table; the second has a column more from
# the second batch on.
SHARED_SINK = tuple(
    (("c", None, _tp("customer", "dim_buyer", "c_custkey,c_name", "c_custkey")),
     ("c", None, _tp("orders", "dim_buyer", cols, "o_custkey")))
    for cols in ("o_custkey,o_orderkey", "o_custkey,o_orderkey,o_orderstatus"))


def config_changelog(spark: SparkSession, changes=CONFIG_CHANGES) -> DataFrame:
    """Config change envelopes ``(value, seq)`` as JSON text."""
    return config_changelog_at(spark, [(i, *c) for i, c in enumerate(changes)])


def config_changelog_at(spark: SparkSession, changes=CONFIG_HISTORY) -> DataFrame:
    """The same with a position of its own for each change."""
    import json
    rows = [(json.dumps({"before": b, "after": a, "op": op, "ts_ms": 1_700_000_000_000 + i}), at)
            for i, (at, op, b, a) in enumerate(changes)]
    return literal_frame(spark, rows, "value string, seq bigint")
