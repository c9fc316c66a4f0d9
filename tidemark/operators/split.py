"""Route a repaired log into its topics.

One pass builds, per line, an array of ``(topic, value)`` pairs and explodes
it, so every topic comes from a single scan and a single sink query can feed
all of them (the ``topic`` column of the Kafka sink):

* dirty line -> ``dirty_data`` (original text)
* ``err`` present -> err topic, the whole record; ``err`` is then removed and
  routing goes on (so such a line is emitted twice)
* ``start`` present -> start topic, and nothing else
* otherwise -> one display record ``{common, page, ts, display}`` per
  element of ``displays``, one action record ``{common, page, action}``
  (no ``ts``) per element of ``actions``, and the page record without
  ``displays``/``actions`` — even when ``page`` is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.record import drop_keys, present, string_map, to_text

# Topic names of the routed log.
TOPIC_DIRTY = "dirty_data"
TOPIC_ERR = "dwd_traffic_err_log"
TOPIC_START = "dwd_traffic_start_log"
TOPIC_PAGE = "dwd_traffic_page_log"
TOPIC_DISPLAY = "dwd_traffic_display_log"
TOPIC_ACTION = "dwd_traffic_action_log"
TOPICS = (TOPIC_PAGE, TOPIC_START, TOPIC_ERR, TOPIC_DISPLAY, TOPIC_ACTION, TOPIC_DIRTY)


def _pair(topic: str, value) -> F.Column:
    return F.struct(F.lit(topic).alias("topic"), value.alias("value"))


def _elements(rec, key: str) -> F.Column:
    arr = F.try_variant_get(F.col(rec)[key], "$", "array<variant>")
    return F.coalesce(arr, F.array().cast("array<variant>"))


def fan_out(df: DataFrame, topics: tuple[str, ...] = TOPICS, with_ts: bool = False) -> DataFrame:
    """``(topic, seq, mid, value)`` for every output record of every line;
    ``topics`` builds the text of those routes only, from the lines that have any.
    ``with_ts`` gives action records the line's ``ts`` as well, which the reference leaves out."""
    # The record comes through a one-row generator, so that the filter below
    # doesn't build the repaired record a second time.
    df = df.select("seq", "mid", "value", "dirty", F.inline(F.array(F.struct("rec"))))
    rec = F.col("rec")
    good = F.col("dirty").isNull()
    has_err = present(rec, "err")
    has_start = present(rec, "start")
    no_err = drop_keys(rec, "err")
    common, page, ts = rec["common"], rec["page"], rec["ts"]

    def displays():
        return F.transform(_elements("rec", "displays"), lambda d: _pair(
            TOPIC_DISPLAY, F.to_json(F.struct(common.alias("common"), page.alias("page"),
                                              ts.alias("ts"), d.alias("display")))))

    def actions():
        return F.transform(_elements("rec", "actions"), lambda a: _pair(
            TOPIC_ACTION, F.to_json(F.struct(common.alias("common"), page.alias("page"),
                                             *([ts.alias("ts")] if with_ts else []), a.alias("action")))))

    arms = {
        TOPIC_DIRTY: (~good, lambda: F.array(_pair(TOPIC_DIRTY, F.col("value")))),
        TOPIC_ERR: (good & has_err, lambda: F.array(_pair(TOPIC_ERR, to_text(rec)))),
        TOPIC_START: (good & has_start, lambda: F.array(_pair(TOPIC_START, to_text(no_err)))),
        TOPIC_DISPLAY: (good & ~has_start, displays),
        TOPIC_ACTION: (good & ~has_start, actions),
        TOPIC_PAGE: (good & ~has_start, lambda: F.array(
            _pair(TOPIC_PAGE, to_text(drop_keys(rec, "err", "displays", "actions"))))),
    }
    empty = F.array().cast("array<struct<topic:string,value:string>>")
    wanted = [arms[t] for t in topics]
    if len(wanted) < len(arms):
        some = wanted[0][0]
        for cond, _ in wanted[1:]:
            some = some | cond
        df = df.filter(some)
    pairs = F.concat(*[F.when(cond, make()).otherwise(empty) for cond, make in wanted])
    return (df.select("seq", "mid", F.explode(pairs).alias("p"))
              .select(F.col("p.topic").alias("topic"), "seq", "mid",
                      F.col("p.value").alias("value")))


def topic_counts(df: DataFrame) -> DataFrame:
    """``(topic, n)``: how many records each topic gets, without building any."""
    good = F.col("dirty").isNull()
    page = good & ~present(F.col("rec"), "start")
    n = {TOPIC_DIRTY: (~good).cast("int"),
         TOPIC_ERR: (good & present(F.col("rec"), "err")).cast("int"),
         TOPIC_START: (good & present(F.col("rec"), "start")).cast("int"),
         TOPIC_DISPLAY: F.when(page, F.size(_elements("rec", "displays"))).otherwise(0),
         TOPIC_ACTION: F.when(page, F.size(_elements("rec", "actions"))).otherwise(0),
         TOPIC_PAGE: page.cast("int")}
    sums = df.agg(*[F.sum(c).cast("bigint").alias(t) for t, c in n.items()])
    rows = F.array(*[F.struct(F.lit(t).alias("topic"), F.col(t).alias("n")) for t in n])
    return sums.select(F.inline(rows)).filter("n > 0")


def page_records(df: DataFrame) -> DataFrame:
    """The page topic as a typed frame, without a JSON round trip: good
    lines without ``start``, with ``common``/``page`` as string maps (the
    declared page-log schema) and the record itself for writers."""
    rec = F.col("rec")
    return (df.filter(F.col("dirty").isNull() & ~present(rec, "start"))
              .select("seq", "mid", "ts", "is_new",
                      string_map(rec["common"]).alias("common"),
                      string_map(rec["page"]).alias("page"),
                      drop_keys(rec, "err", "displays", "actions").alias("rec")))
