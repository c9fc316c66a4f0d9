"""DuckDB oracle SQL for each ``queries()`` key.

Written independently of the Spark plans: the rules of FIXTURES.md applied
straight to the ``events``/``documents``/dimension views, without building
or parsing any JSON. Column names match the Spark outputs.
"""

from __future__ import annotations

# Per-event attributes and the good lines after visitor-flag repair.
_BASE = r"""
WITH ev AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS mid, epoch_us(ts) // 1000 AS ts, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' END AS is_new_in,
         event_type = 'error' AS has_err,
         (event_type = 'signup' OR (event_type = 'error' AND event_id % 4 = 0)) AS has_start,
         CASE event_id % 5 WHEN 2 THEN '' WHEN 3 THEN 'home' WHEN 4 THEN 'search' END AS lp,
         CASE WHEN event_id % 2 = 0 THEN 'keyword' ELSE 'sku_id' END AS item_type,
         CASE WHEN event_id % 7 = 0 THEN NULL
              WHEN event_id % 2 = 0 THEN event_type || ' ' || json_extract_string(props, '$.k')
              ELSE json_extract_string(props, '$.k') END AS item
  FROM events
  UNION ALL
  SELECT 1099511627776 + 2 * doc_id, 'doc' || doc_id, 1704067200000 + doc_id % 86400 * 1000, 'home', doc_id % 100,
         '1', false, false, NULL, NULL, NULL FROM documents
  UNION ALL
  SELECT 1099511627777 + 2 * doc_id, 'doc' || doc_id,
         1704067200000 + doc_id % 86400 * 1000 + CASE WHEN doc_id % 2 = 0 THEN 3000 ELSE 20000 END,
         'good_list', doc_id % 100, '0', false, false, 'search', 'keyword', text FROM documents),
good AS (
  SELECT * REPLACE (CASE WHEN has_start THEN NULL ELSE item END AS item),
         strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS visit_date FROM ev),
rep AS (
  SELECT *, CASE WHEN is_new_in = '1' AND visit_date <> anchor THEN '0' ELSE is_new_in END AS is_new
  FROM (SELECT *, first_value(CASE WHEN is_new_in = '1' THEN visit_date
                    ELSE strftime(make_timestamp((ts - 86400000) * 1000), '%Y-%m-%d') END)
                  OVER (PARTITION BY mid ORDER BY ts, seq) AS anchor
        FROM good) a),
page AS (SELECT * FROM rep WHERE NOT has_start)
"""

_SEARCH = r""",
kf AS (
  SELECT item AS fullword, (ts // 1000) AS sec
  FROM page WHERE lp = 'search' AND item_type = 'keyword' AND item IS NOT NULL),
kx AS (
  SELECT unnest(regexp_extract_all(lower(fullword), '[\p{L}\p{N}]+')) AS keyword, sec FROM kf)
"""


def _fmt(sec_expr: str) -> str:
    return f"strftime(make_timestamp(({sec_expr}) * 1000000), '%Y-%m-%d %H:%M:%S')"


def _jump(within_ms: int) -> str:
    return _BASE + f"""
SELECT seq, mid, is_new, ts, lp AS last_page_id FROM (
  SELECT *, lead(ts) OVER w AS nts, lead(coalesce(lp, '') = '') OVER w AS nempty
  FROM page WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)) x
WHERE coalesce(lp, '') = '' AND (nts IS NULL OR nts - ts >= {within_ms} OR nempty)
"""


def _kw_window(seconds: int) -> str:
    return _BASE + _SEARCH + f"""
SELECT {_fmt(f'(sec // {seconds}) * {seconds}')} AS stt,
       {_fmt(f'(sec // {seconds}) * {seconds} + {seconds}')} AS edt,
       'SEARCH' AS source, keyword, count(*) AS keyword_count
FROM kx GROUP BY 1, 2, 3, 4
"""


# Change records of the dimension tables and orders, and the routed rows
# under the final test config (customer, part, orders configured; supplier
# deleted; nation never configured).
_OSEQ = ("date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 1000000000000"
         " + o_orderkey")
_OTYPE = "CASE WHEN o_orderkey % 10 = 0 THEN 'delete' ELSE 'update' END"
_ROUTED = f"""
WITH routed AS (
  SELECT c_custkey AS seq, 'customer' AS source_table, 'insert' AS type,
         'dim_customer' AS sink_table, CAST(c_custkey AS VARCHAR) AS row_key,
         map {{'c_custkey': CAST(c_custkey AS VARCHAR), 'c_name': c_name, 'c_mktsegment': c_mktsegment}} AS cols FROM customer
  UNION ALL
  SELECT p_partkey, 'part', 'insert', 'dim_part', CAST(p_partkey AS VARCHAR),
         map {{'p_partkey': CAST(p_partkey AS VARCHAR), 'p_name': p_name, 'p_brand': p_brand}} FROM part
  UNION ALL
  SELECT {_OSEQ}, 'orders', {_OTYPE}, 'dim_customer_last_order', CAST(o_custkey AS VARCHAR),
         map {{'o_custkey': CAST(o_custkey AS VARCHAR), 'o_orderkey': CAST(o_orderkey AS VARCHAR),
               'o_orderstatus': o_orderstatus, 'o_orderdate': strftime(o_orderdate, '%Y-%m-%d')}}
  FROM orders)
"""


def _latest(apply_deletes: bool) -> str:
    cond = " AND type <> 'delete'" if apply_deletes else ""
    return _ROUTED + f"""
SELECT sink_table, row_key, seq, type, column_name, cols[column_name] AS column_value FROM (
  SELECT *, unnest(map_keys(cols)) AS column_name, rank() OVER (PARTITION BY sink_table, row_key ORDER BY seq DESC) AS rn
  FROM routed) x
WHERE rn = 1{cond}
"""


_LATE = _BASE + """,
marked AS (SELECT *, ts // 1000 AS sec, max(ts // 1000) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3 AS mark
           FROM page),
found AS (SELECT seq, item AS fullword, sec, mark, (sec // 10 + 1) * 10 AS edge, coalesce((sec // 10 + 1) * 10 <= mark, false) AS late
          FROM marked WHERE lp = 'search' AND item_type = 'keyword' AND item IS NOT NULL)
"""

_DAILY = _BASE + f""",
hit AS (SELECT seq, ts // 1000 AS sec, item AS fullword FROM page WHERE lp = 'search' AND item_type = 'keyword' AND item IS NOT NULL),
word AS (SELECT seq, sec // 86400 AS day, unnest(regexp_extract_all(lower(fullword), '[\\p{{L}}\\p{{N}}]+')) AS keyword FROM hit),
old AS (SELECT day, keyword, count(*) AS n FROM word WHERE seq < 1099511627776 GROUP BY ALL),
new AS (SELECT day, keyword, count(*) AS n FROM word WHERE seq >= 1099511627776 OR day >= 19733 GROUP BY ALL),
change AS (SELECT coalesce(new.day, old.day) AS day, coalesce(new.keyword, old.keyword) AS keyword, new.n AS n
           FROM old FULL JOIN new ON old.day = new.day AND old.keyword = new.keyword WHERE old.n IS DISTINCT FROM new.n)
"""


def _daily(rows: str) -> str:
    return _DAILY + f"""
SELECT {_fmt('day * 86400')} AS stt, {_fmt('day * 86400 + 86400')} AS edt, 'SEARCH' AS source, keyword, n AS keyword_count
FROM {rows}
"""


_CUSTOMER_SEQ, _ORDER_DAY = "c_custkey", "date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))"
# Arrival chunk of a line (see plans.streams).
_CHUNK = "least(3, (ts + seq * 7919 % 86400000 - 1704067200000) // 691200000)"

ORACLE = {
    "parse_log": _BASE + """
SELECT seq, mid, is_new_in AS is_new, ts,
       CASE WHEN has_start THEN NULL ELSE event_type END AS page_id,
       CASE WHEN has_start THEN NULL ELSE lp END AS last_page_id,
       CASE WHEN has_start THEN NULL ELSE item_type END AS item_type,
       item,
       CASE WHEN has_start THEN NULL ELSE k % 4 END AS n_displays,
       CASE WHEN NOT has_start AND event_type = 'purchase' THEN k % 3 END AS n_actions,
       has_err, has_start
FROM good
""",
    "dirty_split": """
SELECT event_id + 2199023255552 AS seq, 'unparsable' AS reason FROM events WHERE event_id % 50 = 0
""",
    "visitor_flag_repair": _BASE + """
SELECT seq, mid, ts, visit_date, is_new_in, is_new FROM rep
""",
    "split_err": _BASE + """
SELECT seq, mid, is_new, ts, k + 1000 AS error_code, has_start,
       CASE WHEN has_start THEN NULL ELSE event_type END AS page_id,
       CASE WHEN has_start THEN NULL ELSE k % 4 END AS n_displays
FROM rep WHERE has_err
""",
    "split_start": _BASE + """
SELECT seq, mid, is_new, ts,
       CASE k % 3 WHEN 0 THEN 'icon' WHEN 1 THEN 'notice' ELSE 'install' END AS entry,
       k * 10 AS loading_time, false AS has_err
FROM rep WHERE has_start
""",
    "split_page": _BASE + """
SELECT seq, mid, is_new, ts, event_type AS page_id, lp AS last_page_id, item_type, item,
       false AS has_err, false AS has_displays, false AS has_actions
FROM page
""",
    "split_display": _BASE + """
SELECT seq, mid, is_new, ts, event_type AS page_id,
       CASE WHEN i % 2 = 0 THEN 'promotion' ELSE 'recommend' END AS display_type,
       CAST(k * 10 + i AS VARCHAR) AS display_item, i + 1 AS display_order,
       (k + i) % 5 AS pos_id
FROM (SELECT *, unnest(range(k % 4)) AS i FROM page) x
""",
    "split_action": _BASE + """
SELECT seq, mid, is_new, event_type AS page_id,
       CASE WHEN i = 0 THEN 'cart_add' ELSE 'favor_add' END AS action_id,
       CAST(k * 10 + i AS VARCHAR) AS action_item, ts + (i + 1) * 1000 AS action_ts,
       false AS has_ts
FROM (SELECT *, unnest(range(k % 3)) AS i FROM page WHERE event_type = 'purchase') x
""",
    "topic_counts": _BASE + """
SELECT topic, n FROM (
  SELECT 'dwd_traffic_err_log' AS topic, CAST(count(*) FILTER (WHERE has_err) AS BIGINT) AS n FROM rep
  UNION ALL SELECT 'dwd_traffic_start_log', CAST(count(*) FILTER (WHERE has_start) AS BIGINT) FROM rep
  UNION ALL SELECT 'dwd_traffic_page_log', CAST(count(*) AS BIGINT) FROM page
  UNION ALL SELECT 'dwd_traffic_display_log', CAST(sum(k % 4) AS BIGINT) FROM page
  UNION ALL SELECT 'dwd_traffic_action_log',
         CAST(sum(CASE WHEN event_type = 'purchase' THEN k % 3 ELSE 0 END) AS BIGINT) FROM page
  UNION ALL SELECT 'dirty_data', CAST(count(*) AS BIGINT) FROM events WHERE event_id % 50 = 0
) t WHERE n > 0
""",
    "unique_visitor": _BASE + """
SELECT seq, mid, is_new, ts, visit_date FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, visit_date ORDER BY ts, seq) AS rn
  FROM page WHERE lp IS NULL) x
WHERE rn = 1
""",
    "user_jump": _jump(10_000),
    "user_jump_6h": _jump(6 * 3600 * 1000),
    "keyword_filter": _BASE + _SEARCH + f"""
SELECT fullword, {_fmt('sec')} AS rowtime FROM kf
""",
    "keyword_explode": _BASE + _SEARCH + f"""
SELECT keyword, {_fmt('sec')} AS rowtime FROM kx
""",
    "keyword_window": _kw_window(10),
    "keyword_window_1d": _kw_window(86400),
    "keyword_window_sql": _kw_window(10),
    "dim_filter_bootstrap": f"""
SELECT c_custkey AS seq, 'customer' AS source_table, 'insert' AS type FROM customer
UNION ALL SELECT p_partkey, 'part', 'insert' FROM part
UNION ALL SELECT s_suppkey, 'supplier', 'insert' FROM supplier
UNION ALL SELECT n_nationkey, 'nation', 'insert' FROM nation
UNION ALL SELECT {_OSEQ}, 'orders', {_OTYPE} FROM orders
""",
    "dim_route": _ROUTED + """
SELECT seq, source_table, type, sink_table, row_key FROM routed
""",
    "dim_prune_columns": f"""
SELECT 'dim_customer' AS sink_table, c_custkey AS seq, CAST(c_custkey AS VARCHAR) AS row_key,
       'c_custkey' AS column_name, CAST(c_custkey AS VARCHAR) AS column_value FROM customer
UNION ALL SELECT 'dim_customer', c_custkey, CAST(c_custkey AS VARCHAR), 'c_name', c_name FROM customer
UNION ALL SELECT 'dim_customer', c_custkey, CAST(c_custkey AS VARCHAR), 'c_mktsegment', c_mktsegment
  FROM customer
UNION ALL SELECT 'dim_part', p_partkey, CAST(p_partkey AS VARCHAR), 'p_partkey', CAST(p_partkey AS VARCHAR)
  FROM part
UNION ALL SELECT 'dim_part', p_partkey, CAST(p_partkey AS VARCHAR), 'p_name', p_name FROM part
UNION ALL SELECT 'dim_part', p_partkey, CAST(p_partkey AS VARCHAR), 'p_brand', p_brand FROM part
UNION ALL SELECT 'dim_customer_last_order', {_OSEQ}, CAST(o_custkey AS VARCHAR), 'o_custkey',
  CAST(o_custkey AS VARCHAR) FROM orders
UNION ALL SELECT 'dim_customer_last_order', {_OSEQ}, CAST(o_custkey AS VARCHAR), 'o_orderkey',
  CAST(o_orderkey AS VARCHAR) FROM orders
UNION ALL SELECT 'dim_customer_last_order', {_OSEQ}, CAST(o_custkey AS VARCHAR), 'o_orderstatus',
  o_orderstatus FROM orders
UNION ALL SELECT 'dim_customer_last_order', {_OSEQ}, CAST(o_custkey AS VARCHAR), 'o_orderdate',
  strftime(o_orderdate, '%Y-%m-%d') FROM orders
""",
    "dim_upsert_latest": _latest(False),
    "dim_upsert_deletes": _latest(True),
    "dim_table_rows": f"SELECT sink_table, row_key, column_name, column_value FROM ({_latest(False)}) t",
    "dim_route_asof": f"""
SELECT c_custkey AS seq, 'customer' AS source_table, 'insert' AS type, 'dim_customer' AS sink_table,
       CAST(c_custkey AS VARCHAR) AS row_key,
       CASE WHEN c_custkey < 70 THEN 'c_custkey,c_name' ELSE 'c_custkey,c_mktsegment,c_name' END AS columns
FROM customer WHERE c_custkey >= 10
UNION ALL SELECT n_nationkey, 'nation', 'insert', 'dim_nation', CAST(n_nationkey AS VARCHAR), 'n_name,n_nationkey'
FROM nation WHERE n_nationkey >= 10
UNION ALL SELECT {_OSEQ}, 'orders', {_OTYPE}, CASE WHEN o_orderdate < DATE '1999-01-01' THEN 'dim_order' ELSE 'dim_order_late' END,
       CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'o_custkey,o_orderkey'
         WHEN o_orderdate < DATE '1999-01-01' THEN 'o_custkey,o_orderkey,o_orderstatus' ELSE 'o_orderdate,o_orderkey' END
FROM orders WHERE (o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01') OR o_orderdate >= DATE '2000-01-01'
""",
    "dim_shared_sink": f"""
WITH o AS (SELECT {_OSEQ} AS seq, CAST(o_custkey AS VARCHAR) AS row_key, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders),
l AS (SELECT row_key, arg_max(o_orderkey, seq) AS o_orderkey, arg_max(o_orderstatus, seq) FILTER (WHERE seq % 2 = 0) AS o_orderstatus
      FROM o GROUP BY row_key),
b AS (SELECT coalesce(CAST(c_custkey AS VARCHAR), row_key) AS row_key, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
             row_key AS o_custkey, o_orderkey, o_orderstatus
      FROM customer FULL JOIN l ON CAST(c_custkey AS VARCHAR) = row_key)
SELECT 'dim_buyer' AS sink_table, row_key, c AS column_name,
       CASE c WHEN 'c_custkey' THEN c_custkey WHEN 'c_name' THEN c_name WHEN 'o_custkey' THEN o_custkey
              WHEN 'o_orderkey' THEN o_orderkey ELSE o_orderstatus END AS column_value
FROM b, (VALUES ('c_custkey'), ('c_name'), ('o_custkey'), ('o_orderkey'), ('o_orderstatus')) v(c)
""",
    "dim_odd_values": """
SELECT 'dim_vendor' AS sink_table, CAST(s_suppkey AS VARCHAR) AS row_key, c AS column_name,
       CASE c WHEN 's_suppkey' THEN CAST(s_suppkey AS VARCHAR)
              WHEN 's_name' THEN CASE WHEN s_suppkey % 5 = 1 THEN 'O' || chr(39) || s_name ELSE s_name END
              ELSE CASE WHEN s_suppkey % 5 <> 2 THEN regexp_replace(CAST(s_acctbal AS VARCHAR), '\\.0$', '') END END AS column_value
FROM supplier, (VALUES ('s_suppkey'), ('s_name'), ('s_acctbal')) v(c) WHERE s_suppkey % 5 IN (1, 2, 4)
""",
    "dim_rejects": """
SELECT s_suppkey AS seq, CASE WHEN s_suppkey % 5 = 0 THEN 'vendor' END AS source_table,
       CASE WHEN s_suppkey % 5 = 0 THEN 'update' END AS type,
       CASE WHEN s_suppkey % 5 = 0 THEN 'no_data' ELSE 'unparsable' END AS reason
FROM supplier WHERE s_suppkey % 5 IN (0, 3)
UNION ALL SELECT NULL, 'lost', NULL, 'bad_key'
""",
    "dic_lookup_asof": f"""
WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '1004' WHEN 'O' THEN '1001' WHEN 'P' THEN '1002' END AS dic_code,
                  CAST({_ORDER_DAY} AS BIGINT) AS day FROM orders),
s AS (SELECT *, day - day % 30 AS seen FROM o),
n AS (SELECT *, CASE dic_code WHEN '1001' THEN CASE WHEN seen < 10500 THEN 'unpaid' ELSE 'awaiting payment' END
  WHEN '1002' THEN CASE WHEN seen >= 9800 THEN 'paid' END
  WHEN '1004' THEN CASE WHEN seen < 10000 THEN 'finished' WHEN seen < 10700 THEN 'done' WHEN seen >= 10900 THEN 'closed' END END AS dic_name
  FROM s)
SELECT o_orderkey, dic_code, day, dic_name, CASE WHEN dic_name IS NOT NULL THEN '10' END AS parent_code FROM n
""",
    "dic_lookup": """
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN '1004' WHEN 'O' THEN '1001' WHEN 'P' THEN '1002' END AS dic_code,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'unpaid' WHEN 'P' THEN 'paid' END AS dic_name,
       '10' AS parent_code
FROM orders
""",
    "fn_to_date": """
SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts,
       strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d') AS date_utc,
       strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S') AS ymd_hms_utc,
       strftime(make_timestamp((epoch_us(ts) // 1000 + 28800000) * 1000), '%Y-%m-%d') AS date_cst
FROM events
""",
    "fn_to_ts": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
       epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) - 28800000 AS ts_ms,
       epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) - 28800000 + 45296000 AS ts_ms_full
FROM orders
""",
    "keyed_messages": _kw_window(86400),
    "keyed_changes": _daily("change"),
    "keyed_replay": _daily("new"),
    "keyword_late_rows": _LATE + f"""
SELECT seq, {_fmt('sec')} AS rowtime, {_fmt('mark')} AS watermark, {_fmt('edge')} AS edt, mark - edge AS behind_s FROM found WHERE late
""",
    "keyword_on_time": _LATE + f"""
SELECT {_fmt('edge - 10')} AS stt, {_fmt('edge')} AS edt, 'SEARCH' AS source, keyword, count(*) AS keyword_count
FROM (SELECT edge, unnest(regexp_extract_all(lower(fullword), '[\\p{{L}}\\p{{N}}]+')) AS keyword FROM found WHERE NOT late) x
GROUP BY ALL
""",
    "stream_flag_repair": _BASE + f"""
SELECT seq, mid, ts, visit_date, is_new_in, CASE WHEN is_new_in = '1' AND visit_date <> anchor THEN '0' ELSE is_new_in END AS is_new
FROM (SELECT *, first_value(CASE WHEN is_new_in = '1' THEN visit_date
                  ELSE strftime(make_timestamp((ts - 86400000) * 1000), '%Y-%m-%d') END)
                OVER (PARTITION BY mid ORDER BY {_CHUNK}, ts, seq) AS anchor FROM good) a
""",
    "stream_unique_visitor": _BASE + """
SELECT seq, mid, ts, visit_date FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, visit_date ORDER BY ts, seq) AS rn
  FROM page WHERE lp IS NULL) x
WHERE rn = 1
""",
    "stream_user_jump": f"SELECT seq, mid, ts, last_page_id FROM ({_jump(10_000)}) j",
    "stream_keyword_window": _kw_window(10),
    "sink_columns": _kw_window(86400),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
