"""Keyword search counts per event-time window.

page log -> search filter -> tokens (lateral explode) -> count per
(tumbling window, keyword). The count is a hash aggregate with a partial
(map-side) step, so a hot keyword is combined before the shuffle; the
tokenizer is a JVM expression, so the whole chain stays in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import TOKEN_PATTERN, tokens
from tidemark.functions.time import fmt_datetime, rowtime, rowtime_instant, wall_clock

# Keyword sources; only SEARCH is produced by the reference.
KEYWORD_SEARCH = "SEARCH"
KEYWORD_CLICK = "CLICK"
KEYWORD_CART = "CART"
KEYWORD_ORDER = "ORDER"

#: State rows over which a window's words are dealt on a stream.
PARTS = 8

WINDOW_FMT = "yyyy-MM-dd HH:mm:ss"  # what fmt_datetime prints
TOKEN_PATTERN_SQL = TOKEN_PATTERN.replace("\\", "\\\\")


def with_rowtime(page_log: DataFrame, zone: str = "UTC") -> DataFrame:
    """Event time in whole seconds, as wall clock in ``zone``."""
    return page_log.withColumn("rowtime", rowtime(F.col("ts"), zone))


def keyword_filter(page_log: DataFrame, zone: str = "UTC") -> DataFrame:
    """Searches by keyword -> ``(fullword, rowtime)``."""
    page = F.col("page")
    lp = F.try_element_at(page, F.lit("last_page_id"))
    it = F.try_element_at(page, F.lit("item_type"))
    item = F.try_element_at(page, F.lit("item"))
    df = page_log if "rowtime" in page_log.columns else with_rowtime(page_log, zone)
    return (df.filter((lp == "search") & (it == "keyword") & item.isNotNull())
              .select(item.alias("fullword"), "rowtime"))


def dealt(search: DataFrame) -> DataFrame:
    """``search`` dealt over the session's shuffle partitions by time and text (a given number, which
    AQE doesn't merge), so that a task counts the words of a small, even share of the searches: its hash of
    (window, word) keys does not follow the size of a file split."""
    return search.repartition(_deal(search.sparkSession), "rowtime", "fullword")


def _deal(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyword_explode(search: DataFrame, tokenizer=tokens) -> DataFrame:
    """J2 + U1: one ``(keyword, rowtime)`` row per token of the whole text;
    a text without tokens yields no row (inner lateral join)."""
    return search.select(F.explode(tokenizer(F.col("fullword"))).alias("keyword"), "rowtime")


def keyword_window(split: DataFrame, duration: str = "10 seconds",
                   source: str = KEYWORD_SEARCH, with_ts: bool = True) -> DataFrame:
    """G1/G2/P14 (+G3): ``stt, edt, source, keyword, keyword_count[, ts]``.

    ``ts`` is the processing-time stamp in ms (non-deterministic, so checks
    leave it out with ``with_ts=False``).
    """
    agg = (split.groupBy(F.window("rowtime", duration).alias("w"), "keyword")
                .agg(F.count(F.lit(1)).alias("keyword_count")))
    return _window_columns(agg, split.schema["rowtime"].dataType, source, with_ts)


def _window_columns(agg: DataFrame, rt_type, source: str, with_ts: bool) -> DataFrame:
    cols = [fmt_datetime(wall_clock("w.start", rt_type)).alias("stt"),
            fmt_datetime(wall_clock("w.end", rt_type)).alias("edt"),
            F.lit(source).alias("source"), "keyword", "keyword_count"]
    if with_ts:
        cols.append((F.unix_timestamp() * F.lit(1000)).alias("ts"))
    return agg.select(*cols)


def keyword_window_state(search: DataFrame, duration: str = "10 seconds", source: str = KEYWORD_SEARCH,
                         with_ts: bool = True, parts: int = PARTS) -> DataFrame:
    """The rows of :func:`keyword_window` over the words of ``search``, for streams.

    A state row for each (window, word) would be nearly one for each word of the stream. Here a
    window's words are dealt over ``parts`` state rows by their hash, each a list of texts (words
    joined by blanks, which no token holds), and are counted when the window closes: all
    occurrences of a word are in one row, and a busy window is in several.
    """
    words = search.select("rowtime", F.transform(tokens("fullword"), lambda w: F.struct(
        w.alias("word"), F.pmod(F.xxhash64(w), F.lit(parts)).alias("part"))).alias("words"))

    def text_of(part: int) -> Column:
        return F.array_join(F.transform(F.filter("words", lambda w: w["part"] == part), lambda w: w["word"]), " ")

    dealt_out = words.select("rowtime", F.posexplode(F.array(*map(text_of, range(parts)))).alias("part", "text"))
    dealt_out = dealt_out.filter(F.col("text") != "")
    g = dealt_out.groupBy(F.window("rowtime", duration).alias("w"), "part").agg(F.collect_list("text").alias("texts"))
    g = g.select("w", F.sort_array(F.split(F.array_join("texts", " "), " ")).alias("words"))
    # where the runs of equal words begin
    g = g.select("w", "words", F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (i == 0) | (
        F.get("words", i) != F.get("words", i - 1))).alias("begin"))
    runs = F.transform("begin", lambda i, n: F.struct(
        F.get("words", i).alias("keyword"),
        (F.coalesce(F.get("begin", n + 1), F.size("words")) - i).cast("long").alias("keyword_count")))
    return _window_columns(g.select("w", F.inline(runs)), search.schema["rowtime"].dataType, source, with_ts)


def keyword_counts(page_log: DataFrame, duration: str = "10 seconds",
                   zone: str = "UTC", with_ts: bool = True) -> DataFrame:
    """The whole keyword job body."""
    search = keyword_filter(page_log, zone)
    if search.isStreaming:
        return keyword_window_state(search, duration, with_ts=with_ts)
    return keyword_window(keyword_explode(dealt(search)), duration, with_ts=with_ts)


def keyword_counts_sql(page_log: DataFrame, duration: str = "10 seconds",
                       zone: str = "UTC", view: str | None = None,
                       delay: str = "3 seconds") -> DataFrame:
    """The same job through Spark SQL over temp views, in the reference's
    three statements: search filter, lateral token explode, window count.
    Catalyst plans it exactly like :func:`keyword_counts`. On a streaming
    frame the view carries an instant ``rowtime`` with a ``delay`` watermark
    (the reference's ``WATERMARK FOR rowtime AS rowtime - INTERVAL '3'
    SECOND``)."""
    import uuid
    spark = page_log.sparkSession
    tag = view or f"page_log_{uuid.uuid4().hex[:8]}"
    if page_log.isStreaming:
        src = (page_log.withColumn("rowtime", rowtime_instant(F.col("ts"), zone))
                       .withWatermark("rowtime", delay))
        # keep the search filter above the watermark (every row moves it)
        src = src.select("rowtime", F.inline(F.array(F.struct(F.col("page").alias("page")))))
    else:
        src = with_rowtime(page_log, zone)
    src.createOrReplaceTempView(tag)
    deal = "" if page_log.isStreaming else f"/*+ REPARTITION({_deal(spark)}, rowtime, fullword) */"
    spark.sql(f"""
        SELECT {deal} page['item'] AS fullword, rowtime FROM {tag}
        WHERE page['last_page_id'] = 'search' AND page['item_type'] = 'keyword'
          AND page['item'] IS NOT NULL""").createOrReplaceTempView(f"{tag}_search")
    spark.sql(f"""
        SELECT keyword, rowtime
        FROM {tag}_search LATERAL VIEW explode(
          regexp_extract_all(lower(fullword), '{TOKEN_PATTERN_SQL}', 0)) t AS keyword
        """).createOrReplaceTempView(f"{tag}_split")
    agg = spark.sql(f"""
        SELECT window AS w, keyword, count(*) AS keyword_count
        FROM {tag}_split GROUP BY window(rowtime, '{duration}'), keyword""")
    for v in (tag, f"{tag}_search", f"{tag}_split"):  # the plan is resolved
        spark.catalog.dropTempView(v)
    rt_type = src.schema["rowtime"].dataType
    return agg.select(fmt_datetime(wall_clock("w.start", rt_type)).alias("stt"),
                      fmt_datetime(wall_clock("w.end", rt_type)).alias("edt"),
                      F.lit(KEYWORD_SEARCH).alias("source"), "keyword", "keyword_count")
