"""The same queries in SQL over the same tables, written independently of the operators."""

from __future__ import annotations

from .queries import QUERIES

SECOND = "'%Y-%m-%d %H:%M:%S'"


def bucket(width: str, t: str = "t") -> str:
    """``stt, edt`` labels of the window a time falls into."""
    start = f"time_bucket(INTERVAL '{width}', {t})"
    return (f"strftime({start}, {SECOND}) AS stt, "
            f"strftime({start} + INTERVAL '{width}', {SECOND}) AS edt")


def at(seconds: str) -> str:
    return f"make_timestamp(CAST(({seconds}) * 1000000 AS BIGINT))"


def text_at(seconds: str) -> str:
    return f"strftime({at(seconds)}, {SECOND})"


def order_s(key: str) -> str:
    return f"(1704067200 + {key} * 7)"


def money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(16,2)) AS VARCHAR)"


VISITS = f"""
events_k AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
visits AS (
  SELECT event_id, event_type, value, k, CAST(user_id AS VARCHAR) AS mid, ts AS t,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
      WHEN 'signup' THEN 'login' ELSE 'order' END AS page_id,
    CASE k % 4 WHEN 1 THEN 'login' WHEN 2 THEN 'search' WHEN 3 THEN 'home' END AS last_page_id,
    CASE WHEN k % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
    'v' || (k % 2) AS vc, 'ch' || (k % 3) AS ch, 'ar' || (user_id % 5) AS ar,
    CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new,
    CAST(floor(value * 1000) AS BIGINT) AS during, epoch_us(ts) // 1000 AS ts,
    CASE WHEN k % 7 <> 0 THEN 'red ' || event_type || ' No.' || k END AS item,
    CASE WHEN k % 3 <> 0 THEN 'keyword' ELSE 'sku_id' END AS item_type,
    k % 10 = 0 AS has_start, k % 6 = 0 AS has_err,
    CASE WHEN k % 4 <> 0 THEN k % 4 ELSE 0 END AS n_displays,
    CASE WHEN k % 3 <> 0 THEN k % 3 ELSE 0 END AS n_actions
  FROM events_k)"""

REPAIRED = """
firsts AS (
  SELECT *, first_value(is_new) OVER w AS f_new, first_value(CAST(t AS DATE)) OVER w AS f_day
  FROM {src} WINDOW w AS (PARTITION BY mid ORDER BY t, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
repaired AS (
  SELECT * EXCLUDE (is_new), CASE WHEN is_new = '1' AND CAST(t AS DATE)
      <> CASE WHEN f_new = '1' THEN f_day ELSE f_day - 1 END THEN '0' ELSE is_new END AS is_new
  FROM firsts)"""

DIC = """
dic AS (SELECT CAST(n_nationkey + 2400 AS VARCHAR) AS code, n_name AS name FROM nation
        WHERE n_nationkey NOT IN (7, 13))"""


def code(n: str) -> str:
    return f"CAST(({n}) % 25 + 2400 AS VARCHAR)"


LINE_S = f"({order_s('l_orderkey')} + l_linenumber)"
LINES = f"""
lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_partkey AS VARCHAR) AS sku_id, 'sku ' || l_partkey AS sku_name,
    {text_at(LINE_S)} AS create_time, CAST(l_suppkey AS VARCHAR) AS source_id,
    {code('l_suppkey')} AS source_type, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sku_num,
    {money('l_extendedprice')} AS split_total_amount, {money('l_tax')} AS split_activity_amount,
    CASE WHEN l_linenumber > 4 THEN {money('l_discount')} END AS split_coupon_amount,
    CAST(CAST(CAST(l_quantity AS DECIMAL(16,2)) * CAST(l_extendedprice AS DECIMAL(16,2))
      AS DECIMAL(33,4)) AS VARCHAR) AS split_original_amount,
    {LINE_S} AS s FROM lineitem)"""
ORDERS = f"""
moves AS (
  SELECT *, {order_s('o_orderkey')} AS s,
    {order_s('o_orderkey')} + CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 1800 ELSE 22 END AS later,
    CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'P' THEN '1005' ELSE '1006' END AS status,
    CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(o_custkey % 25 AS VARCHAR) AS province_id FROM orders)"""
OFFERS = """
keys AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem),
act AS (SELECT k || '-' || n AS line, CAST(k % 5 AS VARCHAR) AS activity_id,
          CAST(n % 4 AS VARCHAR) AS activity_rule_id, CASE WHEN n = 2 THEN 9 ELSE 1 END AS apart FROM keys WHERE (k + n) % 3 = 0),
cou AS (SELECT k || '-' || n AS line, CAST(k % 9 AS VARCHAR) AS coupon_id FROM keys
        WHERE (k + n) % 4 = 0)"""
WIDE = f"""{LINES}, {ORDERS}, {OFFERS}, {DIC},
wide AS (
  SELECT l.id, l.order_id, o.user_id, l.sku_id, l.sku_name, o.province_id, a.activity_id,
    a.activity_rule_id, c.coupon_id, substr(l.create_time, 1, 10) AS date_id, l.create_time,
    l.source_id, l.source_type, d.name AS source_type_name, l.sku_num, l.split_original_amount,
    l.split_activity_amount, l.split_coupon_amount, l.split_total_amount,
    CAST(l.s AS VARCHAR) AS ts, {text_at('l.s')} AS t, l.s
  FROM lines l JOIN dic d ON l.source_type = d.code
  JOIN moves o ON l.order_id = o.id {{near}}
  LEFT JOIN act a ON l.id = a.line {{act_near}} LEFT JOIN cou c ON l.id = c.line)"""
PAID = f"""{WIDE.format(near="", act_near="")},
pays AS (SELECT id AS order_id, {code('o_custkey')} AS payment_type, s + o_orderkey % 1000 + later AS p, good
         FROM (SELECT * EXCLUDE (later, status) FROM moves WHERE o_orderstatus <> 'F') m
         JOIN (VALUES (1, 0, true), (3, -2, false), (5, 1, false), (4, 4, true)) v(every, later, good)
           ON o_orderkey % every = 0),
paid AS (
  SELECT w.id AS order_detail_id, w.order_id, w.user_id, w.sku_id, w.sku_name, w.province_id,
    w.activity_id, w.activity_rule_id, w.coupon_id, p.payment_type AS payment_type_code,
    d.name AS payment_type_name, {text_at('p.p')} AS callback_time, w.source_id,
    w.source_type AS source_type_code, w.source_type_name, w.sku_num, w.split_original_amount,
    w.split_activity_amount, w.split_coupon_amount, w.split_total_amount AS split_payment_amount,
    CAST(p.p AS VARCHAR) AS ts, {text_at('p.p')} AS t
  FROM wide w JOIN pays p ON w.order_id = p.order_id AND w.s BETWEEN p.p - 900 AND p.p + 5 {{good}}
  JOIN dic d ON p.payment_type = d.code
  QUALIFY row_number() OVER (PARTITION BY w.id
    ORDER BY p.p DESC, w.sku_id DESC, w.source_id DESC, w.split_total_amount DESC, w.sku_num DESC) = 1)"""
ASKED_S = f"({LINE_S} + 18)"
REFUNDS = f"""{DIC}, {ORDERS},
asked AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey % 997 AS VARCHAR) AS user_id,
    CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
    {text_at(ASKED_S)} AS create_time, {code('l_linenumber')} AS type_code,
    {code('l_partkey')} AS reason_code, {code('l_suppkey')} AS pay_code,
    'reason ' || l_suppkey AS refund_reason_txt, l_linestatus,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS refund_num,
    {money('l_extendedprice')} AS refund_amount, l_partkey AS part, l_suppkey AS supp, {ASKED_S} AS s
  FROM lineitem WHERE l_returnflag = 'R'),
refunds AS (
  SELECT r.id, r.user_id, r.order_id, r.sku_id, o.province_id, substr(r.create_time, 1, 10) AS date_id,
    r.create_time, r.type_code AS refund_type_code, a.name AS refund_type_name,
    r.reason_code AS refund_reason_type_code, b.name AS refund_reason_type_name,
    r.refund_reason_txt, r.refund_num, r.refund_amount, CAST(r.s AS VARCHAR) AS ts, {text_at('r.s')} AS t, r.s
  FROM asked r JOIN moves o ON r.order_id = o.id AND o.status = '1005' AND o.o_orderkey % 3 <> 0
  JOIN dic a ON r.type_code = a.code JOIN dic b ON r.reason_code = b.code)"""
REFUND_PAY = f"""
requests AS (SELECT *, false AS done FROM asked UNION ALL SELECT *, true FROM asked WHERE part % 2 = 0),
pays AS (SELECT *, supp % 3 = 0 AS moved FROM asked)
SELECT p.id, o.user_id, p.order_id, p.sku_id, o.province_id, p.pay_code AS payment_type_code,
  d.name AS payment_type_name, substr({text_at('p.s + 2')}, 1, 10) AS date_id,
  {text_at('p.s + 2')} AS callback_time, a.refund_num, p.refund_amount, CAST(p.s + 2 AS VARCHAR) AS ts,
  {text_at('p.s + 2')} AS t"""
CARTS = f"""{DIC},
carts AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey % 997 AS VARCHAR) AS user_id,
    CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_suppkey AS VARCHAR) AS source_id,
    {code('l_suppkey')} AS source_type, l_linenumber AS n, CAST(l_quantity AS INTEGER) AS num,
    (l_partkey * 7 + l_linenumber) % 50 + 1 AS before, {LINE_S} AS s FROM lineitem),
grown AS (
  SELECT *, CASE WHEN n = 1 THEN CAST(num AS VARCHAR) ELSE CAST(num - before AS VARCHAR) END AS sku_num
  FROM carts WHERE n = 1 OR (n <> 7 AND num > before))"""
VERSIONS = f"""
versions AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_suppkey % 25 AS VARCHAR) AS province_id,
    CASE WHEN l_suppkey % 17 <> 0 THEN CAST(l_orderkey % 997 AS VARCHAR) END AS user_id,
    CASE WHEN l_suppkey % 19 <> 0 THEN l_linestatus END AS source_type_name,
    CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_quantity AS INTEGER) AS DECIMAL(18,2)) AS original,
    CASE WHEN l_linenumber > 2 THEN CAST(l_tax AS DECIMAL(16,2)) END AS activity,
    CASE WHEN l_linenumber > 4 THEN CAST(l_discount AS DECIMAL(16,2)) END AS coupon,
    CAST(l_extendedprice AS DECIMAL(16,2)) AS total,
    {LINE_S} + l_partkey % 30 AS ts,
    ((l_partkey * 1000000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT)) * 100
      + CAST(round(l_discount * 100) AS BIGINT) AS seq FROM lineitem),
timed AS (SELECT *, {at('ts')} AS t FROM versions)"""
DIMS = """
sku AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name, p_brand AS trademark_id,
          CAST(p_size AS VARCHAR) AS category3_id, CAST(p_partkey % 100 AS VARCHAR) AS spu_id
        FROM part WHERE p_partkey % 101 <> 0),
spu AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS spu_name FROM supplier),
tm AS (SELECT p_brand AS id, min(p_type) AS trademark_name FROM part GROUP BY 1),
c3 AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS category3_name,
         CAST((n_nationkey + 1) % 8 AS VARCHAR) AS category2_id FROM nation),
c2 AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS category2_name,
         CAST(n_regionkey AS VARCHAR) AS category1_id FROM nation WHERE n_nationkey < 7),
c1 AS (SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS category1_name FROM region),
province AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation WHERE n_nationkey <> 3)"""
CHAIN = """LEFT JOIN tm ON trademark_id = tm.id LEFT JOIN c3 ON category3_id = c3.id
  LEFT JOIN c2 ON c3.category2_id = c2.id LEFT JOIN c1 ON c2.category1_id = c1.id"""
RULES = """
fact_rules AS (
  SELECT 't' || (n_nationkey % 10) AS source_table, CASE WHEN n_nationkey < 10 THEN 'insert'
      WHEN n_nationkey < 20 THEN 'update' ELSE 'delete' END AS source_type,
    'dwd_' || lower(n_name) AS sink_table,
    CASE WHEN n_nationkey % 2 = 0 THEN 'id,user_id' ELSE 'id, status' END AS sink_columns, n_nationkey
  FROM nation),
changes AS (
  SELECT 't' || (o_orderkey % 10) AS tab, CASE o_orderstatus WHEN 'F' THEN 'insert'
      WHEN 'O' THEN 'update' ELSE 'delete' END AS type,
    CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS status,
    CAST(1704067200 + o_orderkey * 7 AS VARCHAR) AS ts, o_orderkey FROM orders)"""
FEED = f"""{VISITS},
feed AS (
  SELECT CAST(event_id // 3 + 1 AS BIGINT) AS seq, event_id AS pos, CAST(mid AS BIGINT) AS n, event_type,
    CASE WHEN k % 2 = 0 THEN 'insert' ELSE 'update' END AS typ, 'k' || event_id AS sink,
    CASE WHEN CAST(mid AS BIGINT) % 5 = 0 THEN 'dim' ELSE 'dwd' END AS kind FROM visits),
steps AS (
  SELECT seq, pos, 0 AS step, 's' || n AS st, typ, kind, NULL AS sink FROM feed
    WHERE event_type IN ('error', 'signup')
  UNION ALL
  SELECT seq, pos, 1, 's' || CASE WHEN event_type = 'signup' THEN n + 5 ELSE n END, typ, kind, sink
    FROM feed WHERE event_type <> 'error')"""


def fold(kind: str, keys: str, src: str = "steps") -> str:
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY seq DESC, pos DESC, step DESC) AS rn
  FROM {src} WHERE kind = '{kind}')
SELECT st AS source_table, typ AS source_type, sink AS sink_table, {{cols}} AS sink_columns
FROM ranked WHERE rn = 1 AND sink IS NOT NULL"""


def user_days(src: str, user: str, unique: str, new: str, width: str) -> str:
    return f"""seen AS (
  SELECT {user} AS u, t, lag(CAST(t AS DATE)) OVER w AS before, row_number() OVER w AS rn
  FROM {src} WINDOW w AS (PARTITION BY {user} ORDER BY t))
SELECT {bucket(width)},
  CAST(sum(CASE WHEN before IS NULL OR before <> CAST(t AS DATE) THEN 1 ELSE 0 END) AS BIGINT) AS {unique},
  CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS {new}
FROM seen GROUP BY 1, 2"""


def channel(width: str) -> str:
    return f"""WITH {VISITS},
seen AS (SELECT *, row_number() OVER (PARTITION BY mid, CAST(t AS DATE) ORDER BY t, event_id) AS rn FROM visits)
SELECT {bucket(width)}, vc, ch, ar, is_new,
  CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS uv_ct,
  CAST(sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct,
  count(*) AS pv_ct, CAST(sum(during) AS BIGINT) AS dur_sum
FROM seen GROUP BY ALL"""


CROWD = """
crowd AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 'crowd' ELSE mid END AS mid) FROM visits)"""

LATE = f"""{VISITS},
arrivals AS (SELECT event_id AS arrival, t - to_minutes(k) AS t FROM visits),
seen AS (SELECT arrival, t, max(t) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING
           AND 1 PRECEDING) AS top FROM arrivals),
marked AS (SELECT arrival, t, coalesce(time_bucket(INTERVAL '10 seconds', t) + INTERVAL '10 seconds'
             + to_seconds({{slack}}) <= top, false) AS late FROM seen)"""

ROUTES = """
routes AS (
  SELECT 'error' AS route, is_new, page_id, 1 AS n FROM {src} WHERE has_err
  UNION ALL SELECT 'start', is_new, page_id, 1 FROM {src} WHERE has_start
  UNION ALL SELECT 'page', is_new, page_id, 1 FROM {src} WHERE NOT has_start
  UNION ALL SELECT 'display', is_new, page_id, n_displays FROM {src} WHERE NOT has_start AND n_displays > 0
  UNION ALL SELECT 'action', is_new, page_id, n_actions FROM {src} WHERE NOT has_start AND n_actions > 0)"""

HAN = "translate(lower({c}), 'abcdefghijklmnopqrstuvwxyz', '" + "".join(map(chr, range(0x4E00, 0x4E1A))) + "')"
TOKENS = r"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"

SQL: dict[str, str] = {
    "log_dirty_split": """SELECT CASE WHEN event_id % 10 IN (3, 6, 7) THEN 'dirty' ELSE 'good' END AS route,
        count(*) AS n FROM events GROUP BY 1""",
    "object_split": """SELECT event_id, CASE WHEN event_id % 10 IN (3, 6, 7) THEN 'other' ELSE 'object' END AS route
        FROM events""",
    "log_topics": f"""WITH {VISITS}, good AS (SELECT * FROM visits WHERE event_id % 10 NOT IN (3, 6, 7)),
        {REPAIRED.format(src='good')},
        said AS (SELECT mid, uid, vc, ch, ar, is_new, 'os ' || (event_id % 4) AS os, page_id, last_page_id, item, item_type,
          CAST(during AS VARCHAR) AS during_time, CAST(event_id % 9 AS VARCHAR) AS source_type,
          CASE WHEN has_start THEN '{{"entry":"icon"}}' END AS start, CASE WHEN has_err THEN '{{"error_code":1}}' END AS err,
          n_displays, n_actions, CAST(ts AS VARCHAR) AS ts, '{{"n":' || (event_id % 100) || ',"list":["a","b"]}}' AS extra
          FROM repaired),
        lines AS (
          SELECT 'error' AS topic, NULL AS display, NULL AS action, * FROM said WHERE err IS NOT NULL
          UNION ALL SELECT 'start', NULL, NULL, * REPLACE (NULL AS err) FROM said WHERE start IS NOT NULL
          UNION ALL SELECT 'page', NULL, NULL, * REPLACE (NULL AS err) FROM said WHERE start IS NULL
          UNION ALL SELECT 'display', '{{"order":' || unnest(generate_series(1, n_displays)) || '}}', NULL,
            * REPLACE (NULL AS err, NULL AS extra) FROM said WHERE start IS NULL
          UNION ALL SELECT 'action', NULL, '{{"action_id":' || unnest(generate_series(1, n_actions)) || '}}',
            * REPLACE (NULL AS err, NULL AS extra, NULL AS ts) FROM said WHERE start IS NULL)
        SELECT 'dwd_traffic_' || topic || '_log' AS topic, list_aggregate(list_sort([x FOR x IN [
            CASE WHEN action IS NOT NULL OR (topic IN ('error', 'start') AND n_actions > 0)
              THEN CASE WHEN action IS NULL THEN 'actions' ELSE 'action' END END,
            CASE WHEN display IS NOT NULL OR (topic IN ('error', 'start') AND n_displays > 0)
              THEN CASE WHEN display IS NULL THEN 'displays' ELSE 'display' END END,
            'common', 'page', CASE WHEN err IS NOT NULL THEN 'err' END, CASE WHEN start IS NOT NULL THEN 'start' END,
            CASE WHEN ts IS NOT NULL THEN 'ts' END, CASE WHEN extra IS NOT NULL THEN 'extra' END] IF x IS NOT NULL]),
            'string_agg', ',') AS keys,
          mid AS common_mid, uid AS common_uid, vc AS common_vc, ch AS common_ch, ar AS common_ar, is_new AS common_is_new,
          os AS common_os, page_id AS page_page_id, last_page_id AS page_last_page_id, item AS page_item,
          item_type AS page_item_type, during_time AS page_during_time, source_type AS page_source_type,
          start, err, display, action, ts, CASE WHEN extra IS NOT NULL THEN '{{"list":["a","b"],"n":' || regexp_extract(extra, '[0-9]+') || '}}' END AS extra
        FROM lines
        UNION ALL SELECT 'dirty_data', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
          NULL, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_id % 10 IN (3, 6, 7)""",
    "log_split_routes": f"""WITH {VISITS}, {ROUTES.format(src='visits')}
        SELECT route, page_id, CAST(sum(n) AS BIGINT) AS n FROM routes GROUP BY ALL""",
    "log_display_explode": f"""WITH {VISITS}
        SELECT CAST(unnest(generate_series(1, n_displays)) AS VARCHAR) AS display_order, mid, page_id, ts
        FROM visits WHERE NOT has_start AND n_displays > 0""",
    "log_action_explode": f"""WITH {VISITS}
        SELECT CAST(unnest(generate_series(1, n_actions)) AS VARCHAR) AS action_id, mid, page_id
        FROM visits WHERE NOT has_start AND n_actions > 0""",
    "log_error_records": f"""WITH {VISITS} SELECT event_id, '{{"error_code":1}}' AS err,
        CASE WHEN has_start THEN '{{"entry":"icon"}}' END AS start FROM visits WHERE has_err""",
    "visitor_flag_repair": f"WITH {VISITS}, {REPAIRED.format(src='visits')} SELECT event_id, mid, is_new FROM repaired",
    "cdc_valid_rows": f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, 'order_info' AS "table",
        CASE o_orderkey % 6 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS type,
        {text_at(order_s('o_orderkey'))} AS event_time
        FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 6 IN (0, 1, 5)""",
    "cdc_insert_select": f"WITH {LINES} SELECT * EXCLUDE (s), CAST(s AS VARCHAR) AS ts FROM lines",
    "cdc_map_project": f"""WITH {ORDERS}
        SELECT id, user_id, CAST(NULL AS VARCHAR) AS operate_time, CAST(NULL AS VARCHAR) AS no_such_key,
          '1001' AS status FROM moves
        UNION ALL SELECT id, user_id, {text_at('later')}, NULL, status FROM moves""",
    "cdc_status_transition": f"""WITH {ORDERS} SELECT id, {text_at('later')} AS operate_time,
        CAST(later AS VARCHAR) AS ts FROM moves WHERE status = '1003' AND o_orderkey % 3 <> 0""",
    "cart_delta": f"WITH {CARTS} SELECT id, sku_id, sku_num FROM grown",
    "cart_add_detail": f"""WITH {CARTS} SELECT id, user_id, sku_id, source_id, source_type AS source_type_code,
        d.name AS source_type_name, sku_num, CAST(s AS VARCHAR) AS ts, {text_at('s')} AS t
        FROM grown JOIN dic d ON source_type = d.code""",
    "line_amount": """SELECT l_orderkey, l_linenumber, CAST(CAST(CAST(l_quantity AS DECIMAL(16,2))
        * CAST(l_extendedprice AS DECIMAL(16,2)) AS DECIMAL(33,4)) AS VARCHAR) AS amount FROM lineitem""",
    "rule_fold_facts": f"WITH {FEED}, " + fold("dwd", "st, typ").format(cols="'id,name'"),
    "rule_fold_dims": f"WITH {FEED}, " + fold("dim", "st").format(cols="'id,name'"),
    "rule_precedence": f"""WITH {FEED}, {RULES},
        both_steps AS (SELECT seq, pos, step, st, typ, kind, sink, 'id,name' AS cols FROM steps
          UNION ALL SELECT 0, 0, 1, 's' || substr(source_table, 2), source_type, 'dwd', sink_table, sink_columns
          FROM fact_rules), """ + fold("dwd", "st, typ", "both_steps").format(cols="cols"),
    "rule_route_facts": f"""WITH {RULES}
        SELECT r.sink_table, 'data,database,sink_table,table,ts,type,xid,xoffset' AS keys,
          CASE WHEN n_nationkey % 2 = 0 THEN '{{"id":' || c.id || ',"user_id":' || c.user_id || '}}'
            ELSE '{{"id":' || c.id || ',"status":"' || c.status || '"}}' END AS data,
          'shop' AS database, c.tab AS "table", c.type, c.ts, CAST(CAST(c.ts AS BIGINT) % 1000 AS VARCHAR) AS xid,
          '0' AS xoffset, r.sink_table AS said_sink
        FROM changes c JOIN fact_rules r ON c.tab = r.source_table AND c.type = r.source_type""",
    "rule_route_dims": f"""WITH {RULES}
        SELECT 'dim_' || lower(n_name) AS sink_table, CASE WHEN n_nationkey > 2 THEN 'user_id' ELSE 'id' END
          AS sink_pk, c.type, CAST(NULL AS VARCHAR) AS id, c.user_id, c.status
        FROM changes c JOIN nation ON c.tab = 't' || n_nationkey AND n_nationkey < 6""",
    "dim_table_from_rule": """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
        CAST(p_size AS VARCHAR) AS p_size FROM part""",
    "dim_upsert_latest": f"""WITH {VISITS}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY mid ORDER BY t DESC, event_id DESC) AS rn FROM visits)
        SELECT mid AS id, page_id AS name, ch AS channel FROM ranked WHERE rn = 1""",
    "dict_lookup": f"""WITH {DIC}, li AS (SELECT l_orderkey || '-' || l_linenumber AS id,
        {code('l_suppkey')} AS source_type FROM lineitem)
        SELECT id, source_type, name AS source_type_name FROM li JOIN dic ON source_type = code""",
    "dict_lookup_twice": f"""WITH {DIC}, li AS (SELECT l_orderkey || '-' || l_linenumber AS id,
        {code('l_suppkey')} AS source_type, {code('l_partkey')} AS reason FROM lineitem)
        SELECT id, source_type, reason, a.name AS source_type_name, b.name AS reason_name
        FROM li JOIN dic a ON source_type = a.code JOIN dic b ON reason = b.code""",
    "within_ttl_join": f"""WITH {LINES}, {ORDERS} SELECT l.id, l.order_id, o.user_id, CAST(l.s AS VARCHAR) AS ts
        FROM lines l JOIN moves o ON l.order_id = o.id AND abs(l.s - o.s) <= 5""",
    "left_ttl_join": f"""WITH {LINES}, {OFFERS} SELECT id, activity_id, CAST(s AS VARCHAR) AS ts
        FROM lines LEFT JOIN act ON id = line AND apart <= 5""",
    "two_key_join": f"""WITH {REFUNDS} SELECT p.id, p.order_id, p.sku_id, p.refund_amount AS total_amount,
        a.refund_num FROM asked p JOIN (SELECT * FROM asked UNION ALL SELECT * FROM asked WHERE part % 2 = 0) a
        ON p.order_id = a.order_id AND p.sku_id = a.sku_id""",
    "interval_join": f"""WITH {VISITS} SELECT c.event_id, p.event_id AS purchase_id, c.mid
        FROM visits c JOIN visits p ON c.mid = p.mid AND c.event_type = 'click' AND p.event_type = 'purchase'
        AND c.t >= p.t - INTERVAL '15 hours' AND c.t <= p.t + INTERVAL '5 minutes'""",
    "dim_enrich": f"""WITH {DIMS} SELECT o_orderkey, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
        coalesce(name, '') AS province_name FROM orders LEFT JOIN province
        ON CAST(o_custkey % 25 AS VARCHAR) = id""",
    "dim_enrich_two_keys": f"""WITH {DIMS} SELECT l_orderkey || '-' || l_linenumber AS id,
        CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_partkey % 100 AS VARCHAR) AS spu, sku_name
        FROM lineitem LEFT JOIN sku ON CAST(l_partkey AS VARCHAR) = sku.id
        AND CAST(l_partkey % 100 AS VARCHAR) = spu_id""",
    "dim_by_pairs": f"""WITH {DIMS} SELECT id, sku_name, trademark_id AS tm_id, category3_id, spu_id FROM sku
        WHERE trademark_id = 'Brand#2' AND category3_id = '11'""",
    "snowflake_enrich": f"""WITH {DIMS}, li AS (SELECT l_orderkey || '-' || l_linenumber AS line,
        CAST(l_partkey AS VARCHAR) AS sku_id FROM lineitem)
        SELECT line AS id, sku_id, sku_name, spu_id, trademark_id, category3_id, spu_name, trademark_name,
          category3_name, category2_id, category2_name, category1_id, category1_name
        FROM li LEFT JOIN sku ON sku_id = sku.id LEFT JOIN spu ON spu_id = spu.id {CHAIN}""",
    "topic_append_reread": f"""WITH {VISITS} SELECT event_id, mid, page_id, last_page_id, CAST(ts // 1000 AS VARCHAR) AS ts,
        strftime(t, {SECOND}) AS t FROM visits""",
    "topic_per_row": f"""WITH {VISITS} SELECT event_id, mid, 'dwd_' || event_type AS topic FROM visits
        WHERE event_type IN ('view', 'click', 'purchase')""",
    "keyed_upsert": f"""WITH {VISITS}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY mid ORDER BY event_id % 3 DESC, t DESC, event_id DESC) AS rn FROM visits)
        SELECT mid, event_id, page_id, strftime(t, {SECOND}) AS t FROM ranked WHERE rn = 1 AND event_type <> 'error'""",
    "summary_added_once": f"""WITH {VISITS} SELECT {bucket('1 hour')}, page_id, count(*) AS n, CAST(event_id % 3 AS INTEGER) AS part
        FROM visits GROUP BY ALL""",
    "dim_tombstones": f"""WITH {VISITS} SELECT 'dim_visit' AS topic, '{{"event_id":' || event_id || '}}' AS key, event_id, page_id
        FROM visits WHERE k % 4 <> 0""",
    "log_maps": f"""WITH {VISITS} SELECT event_id, mid, ch, page_id, epoch_us(t) // 1000000 * 1000000 AS us FROM visits
        WHERE event_id % 10 NOT IN (3, 6, 7)""",
    "rules_preloaded": f"WITH {RULES} SELECT source_table, source_type, sink_table, sink_columns FROM fact_rules",
    "dictionary_table": f"""WITH {LINES}, {DIC} SELECT id, source_type, name AS source_type_name
        FROM lines JOIN dic ON source_type = code""",
    "emit_and_processing_time": f"""SELECT {bucket('1 hour', at(order_s('o_orderkey')))}, count(*) AS n, true AS stamped, true AS processed
        FROM orders GROUP BY 1, 2""",
    "flat_goods": f"""WITH {DIMS} SELECT sku.id, sku_name, spu_id, trademark_id, category3_id, spu_name, trademark_name,
        category3_name, category2_id, category2_name, category1_id, category1_name
        FROM sku LEFT JOIN spu ON spu_id = spu.id {CHAIN}""",
    "order_detail_wide": f"WITH {WIDE.format(near='', act_near='')} SELECT * EXCLUDE (s) FROM wide",
    "order_detail_text": f"WITH {WIDE.format(near='', act_near='')} SELECT * EXCLUDE (s) FROM wide",
    "order_detail_bounded": f"""WITH {WIDE.format(near='AND abs(l.s - o.s) <= 5', act_near='AND a.apart <= 5')}
        SELECT * EXCLUDE (s) FROM wide""",
    "order_cancel_wide": f"""WITH {LINES}, {ORDERS}, {OFFERS}, {DIC}
        SELECT l.id, l.order_id, o.user_id, l.sku_id, l.sku_name, o.province_id, activity_id, activity_rule_id,
          coupon_id, substr({text_at('later')}, 1, 10) AS date_id, {text_at('later')} AS cancel_time, l.source_id,
          l.source_type AS source_type_code, d.name AS source_type_name, l.sku_num, l.split_original_amount,
          l.split_activity_amount, l.split_coupon_amount, l.split_total_amount, CAST(later AS VARCHAR) AS ts, {text_at('later')} AS t
        FROM lines l JOIN moves o ON l.order_id = o.id AND status = '1003' AND o_orderkey % 3 <> 0
        JOIN dic d ON l.source_type = d.code LEFT JOIN act a ON l.id = a.line LEFT JOIN cou c ON l.id = c.line""",
    "order_refund_wide": f"WITH {REFUNDS} SELECT * EXCLUDE (s) FROM refunds",
    "refund_pay_wide": f"""WITH {REFUNDS}, {REFUND_PAY}
        FROM requests a JOIN pays p ON p.order_id = a.order_id AND p.sku_id = a.sku_id
        JOIN moves o ON p.order_id = o.id JOIN dic d ON p.pay_code = d.code WHERE p.l_linestatus = 'F'""",
    "refund_pay_strict": f"""WITH {REFUNDS}, {REFUND_PAY}
        FROM requests a JOIN pays p ON p.order_id = a.order_id AND p.sku_id = a.sku_id AND a.done AND p.moved
        JOIN moves o ON p.order_id = o.id AND o.status = '1006' AND o.o_orderkey % 3 <> 0
        JOIN dic d ON p.pay_code = d.code WHERE p.l_linestatus = 'F'""",
    "pay_detail_wide": f"WITH {PAID.format(good='')} SELECT * FROM paid",
    "order_detail_upsert": f"""WITH {VERSIONS}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY id ORDER BY ts DESC, seq DESC) AS rn FROM versions)
        SELECT id, order_id, sku_id, province_id, user_id, CAST(original AS VARCHAR) AS split_original_amount,
          CAST(activity AS VARCHAR) AS split_activity_amount, CAST(coupon AS VARCHAR) AS split_coupon_amount,
          CAST(total AS VARCHAR) AS split_total_amount, ts FROM ranked WHERE rn = 1""",
    "keyword_tokens": f"""WITH w AS (SELECT lang, unnest({TOKENS.format(text='text')}) AS word FROM documents)
        SELECT lang, word, count(*) AS n FROM w GROUP BY ALL""",
    "keyword_tokens_listed": f"""WITH RECURSIVE listed AS (
          SELECT DISTINCT {HAN.format(c='substr(n_name, a, n)')} AS w FROM nation, (VALUES (1), (2), (3)) AS p(a), (VALUES (2), (3)) AS q(n)),
        runs AS (SELECT p_partkey, k, unnest(regexp_extract_all({HAN.format(c='p_name')}, '[\\x{{4E00}}-\\x{{4E19}}]+')) AS run
          FROM (SELECT p_partkey, p_name, row_number() OVER () AS k FROM part)),
        found AS (SELECT run, pos, max(len(w)) AS size
          FROM (SELECT DISTINCT run FROM runs), generate_series(1, 40) AS g(pos), listed
          WHERE pos <= len(run) AND substr(run, pos, len(w)) = w AND len(w) > 1 GROUP BY run, pos),
        cut AS (
          SELECT run, CAST(1 AS BIGINT) AS pos, CAST(NULL AS VARCHAR) AS word FROM (SELECT DISTINCT run FROM runs)
          UNION ALL
          SELECT c.run, c.pos + coalesce(f.size, 1), substr(c.run, c.pos, coalesce(f.size, 1))
          FROM cut c LEFT JOIN found f ON c.run = f.run AND c.pos = f.pos WHERE c.pos <= len(c.run))
        SELECT p_partkey, word FROM runs JOIN cut USING (run) WHERE word IS NOT NULL""",
    "keyword_tokens_smart": f"""WITH RECURSIVE listed AS (
          SELECT DISTINCT w FROM (
            SELECT {HAN.format(c='substr(n_name, a, n)')} AS w FROM nation, (VALUES (1), (2), (3)) AS p(a), (VALUES (2), (3), (4)) AS q(n)
            UNION ALL SELECT {HAN.format(c="substr(regexp_replace(p_name, '[^A-Za-z]', '', 'g'), a, n)")}
            FROM part, (VALUES (1), (2), (4), (7)) AS p(a), (VALUES (2), (3), (5)) AS q(n) WHERE p_partkey % 5 = 1) WHERE len(w) > 1),
        runs AS (SELECT p_partkey, k, unnest(regexp_extract_all({HAN.format(c='p_name')}, '[\\x{{4E00}}-\\x{{4E19}}]+')) AS run
          FROM (SELECT p_partkey, p_name, row_number() OVER () AS k FROM part)),
        tried AS (SELECT run, pos, n, substr(run, pos, n) AS w FROM (SELECT DISTINCT run FROM runs), generate_series(1, 40) AS g(pos), generate_series(2, 5) AS h(n)
          WHERE pos + n <= len(run) + 1),
        fit AS (SELECT run, pos, list(n) AS sizes FROM tried SEMI JOIN listed USING (w) GROUP BY run, pos),
        best AS (
          SELECT run, len(run) + 1 AS pos, [{{'covered': 0, 'less': 0, 'size': 0}}] AS b FROM (SELECT DISTINCT run FROM runs)
          UNION ALL
          SELECT d.run, d.pos - 1, list_prepend(list_max(list_transform(list_append(coalesce(f.sizes, []), 1), lambda s: {{
            'covered': (b[s].covered + CASE WHEN s > 1 THEN s ELSE 0 END)::INTEGER, 'less': (b[s].less - 1)::INTEGER, 'size': s::INTEGER}})), b)
          FROM best d LEFT JOIN fit f ON d.run = f.run AND f.pos = d.pos - 1 WHERE d.pos > 1),
        cut AS (
          SELECT run, 1 AS pos, CAST(NULL AS VARCHAR) AS word, list_transform(b, lambda x: x.size) AS pick FROM best WHERE pos = 1
          UNION ALL
          SELECT run, (pos + pick[pos])::INTEGER, substr(run, pos, pick[pos]), pick FROM cut WHERE pos <= len(run))
        SELECT p_partkey, word FROM runs JOIN cut USING (run) WHERE word IS NOT NULL""",
    "keyword_tokens_name": f"SELECT p_partkey, unnest({TOKENS.format(text='p_name')}) AS word FROM part",
    "keyword_window": f"""WITH {VISITS}, w AS (SELECT t, unnest({TOKENS.format(text='item')}) AS keyword
        FROM visits WHERE item IS NOT NULL AND last_page_id = 'search' AND item_type = 'keyword')
        SELECT {bucket('10 seconds')}, keyword, count(*) AS keyword_count FROM w GROUP BY ALL""",
    "first_of_day": f"""WITH {VISITS}, seen AS (SELECT *, lag(CAST(t AS DATE)) OVER
        (PARTITION BY mid ORDER BY t, event_id) AS before FROM visits)
        SELECT mid, event_id, event_type FROM seen WHERE before IS NULL OR before <> CAST(t AS DATE)""",
    "cart_uu_window": f"""WITH {CARTS}, added AS (SELECT user_id, {at('s')} AS t FROM grown
          JOIN dic ON source_type = code),
        seen AS (SELECT t, lag(CAST(t AS DATE)) OVER (PARTITION BY user_id ORDER BY t) AS before FROM added)
        SELECT {bucket('10 seconds')}, count(*) AS cart_add_uu_ct FROM seen
        WHERE before IS NULL OR before <> CAST(t AS DATE) GROUP BY ALL""",
    "order_user_window": f"WITH {WIDE.format(near='', act_near='')}, placed AS (SELECT user_id, {at('s')} AS t FROM wide), " + user_days(
        "placed", "user_id", "order_unique_user_count", "order_new_user_count", "10 seconds"),
    "purchase_user_window": f"WITH {VISITS}, bought AS (SELECT * FROM visits WHERE event_type = 'purchase'), "
        + user_days("bought", "mid", "payment_suc_unique_user_count", "payment_suc_new_user_count", "1 hour"),
    "payment_user_window": f"WITH {PAID.format(good='')}, done AS (SELECT user_id, {at('CAST(ts AS BIGINT)')} AS t FROM paid), " + user_days(
        "done", "user_id", "payment_suc_unique_user_count", "payment_suc_new_user_count", "10 seconds"),
    "page_uv_window": f"""WITH {VISITS}, seen AS (SELECT page_id, t, lag(CAST(t AS DATE)) OVER
          (PARTITION BY mid, page_id ORDER BY t) AS before FROM visits WHERE page_id IN ('home', 'good_detail'))
        SELECT {bucket('10 seconds')},
          CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_ct,
          CAST(sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS BIGINT) AS good_detail_uv_ct
        FROM seen WHERE before IS NULL OR before <> CAST(t AS DATE) GROUP BY ALL""",
    "login_back_window": f"""WITH {VISITS}, logins AS (SELECT uid, t, CAST(t AS DATE) AS d, lag(CAST(t AS DATE))
          OVER (PARTITION BY uid ORDER BY t) AS before FROM visits
          WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login'))
        SELECT {bucket('10 seconds')},
          CAST(sum(CASE WHEN d - before >= 8 THEN 1 ELSE 0 END) AS BIGINT) AS back_ct, count(*) AS uu_ct
        FROM logins WHERE before IS NULL OR before <> d GROUP BY ALL""",
    "register_window": f"""SELECT {bucket('10 seconds', 'ts')}, count(*) AS register_ct FROM events
        WHERE event_type = 'signup' GROUP BY ALL""",
    "channel_pv_window": channel("10 seconds"),
    "channel_pv_hour": channel("1 hour"),
    "retract_changelog": f"""WITH {VERSIONS}, filled AS (SELECT id, sku_id, total AS o,
          coalesce(coupon, 0) AS c, t, seq FROM timed),
        paired AS (SELECT *, lag(sku_id) OVER w AS p_sku, lag(o) OVER w AS p_o, lag(c) OVER w AS p_c,
          lag(t) OVER w AS p_t, lag(seq) OVER w AS p_seq FROM filled
          WINDOW w AS (PARTITION BY id ORDER BY t, seq))
        SELECT id, sku_id, CAST(CAST(o AS DECIMAL(18,2)) AS VARCHAR) AS order_amount,
          CAST(CAST(c AS DECIMAL(18,2)) AS VARCHAR) AS coupon_amount, seq, 1 AS sign,
          strftime(t, {SECOND}) AS event_time FROM paired
        UNION ALL
        SELECT id, p_sku, CAST(CAST(-p_o AS DECIMAL(18,2)) AS VARCHAR),
          CAST(CAST(-p_c AS DECIMAL(18,2)) AS VARCHAR), p_seq, -1,
          strftime(p_t, {SECOND}) FROM paired WHERE p_t IS NOT NULL""",
    "order_count_once": f"""WITH {VERSIONS}, seen AS (SELECT *, row_number() OVER (PARTITION BY order_id
          ORDER BY t, seq, id) AS rn FROM timed)
        SELECT order_id, id, seq, CAST(CASE WHEN rn = 1 THEN 1 ELSE 0 END AS BIGINT) AS once FROM seen""",
    "sku_order_window": f"""WITH {VERSIONS}, {DIMS}, kept AS (SELECT *, row_number() OVER
          (PARTITION BY id ORDER BY t DESC, seq DESC) AS rn FROM timed
          WHERE user_id IS NOT NULL AND source_type_name IS NOT NULL),
        net AS (SELECT {bucket('10 seconds')}, sku_id AS k,
          sum(CASE WHEN rn = 1 THEN original ELSE 0 END) AS o,
          sum(CASE WHEN rn = 1 THEN coalesce(activity, 0) ELSE 0 END) AS a,
          sum(CASE WHEN rn = 1 THEN coalesce(coupon, 0) ELSE 0 END) AS c,
          sum(CASE WHEN rn = 1 THEN total ELSE 0 END) AS s FROM kept GROUP BY ALL)
        SELECT stt, edt, trademark_id, trademark_name, category1_id, category1_name, c3.category2_id,
          category2_name, category3_id, category3_name, k AS sku_id, sku_name, spu_id, spu_name,
          CAST(CAST(o AS DECIMAL(18,2)) AS VARCHAR) AS original_amount,
          CAST(CAST(a AS DECIMAL(18,2)) AS VARCHAR) AS activity_amount,
          CAST(CAST(c AS DECIMAL(18,2)) AS VARCHAR) AS coupon_amount,
          CAST(CAST(s AS DECIMAL(18,2)) AS VARCHAR) AS order_amount
        FROM net LEFT JOIN sku ON k = sku.id LEFT JOIN spu ON spu_id = spu.id {CHAIN}""",
    "province_order_window": f"""WITH {VERSIONS}, {DIMS}, kept AS (SELECT *,
          row_number() OVER (PARTITION BY id ORDER BY t DESC, seq DESC, id DESC) AS rn,
          row_number() OVER (PARTITION BY order_id ORDER BY t, seq, id) AS first_rn FROM timed),
        net AS (SELECT {bucket('10 seconds')}, province_id,
          CAST(sum(CASE WHEN first_rn = 1 THEN 1 ELSE 0 END) AS BIGINT) AS order_count,
          sum(CASE WHEN rn = 1 THEN total ELSE 0 END) AS s FROM kept GROUP BY ALL)
        SELECT stt, edt, province_id, coalesce(name, '') AS province_name, order_count,
          CAST(CAST(s AS DECIMAL(18,2)) AS VARCHAR) AS order_amount
        FROM net LEFT JOIN province ON province_id = id""",
    "refund_distinct_window": f"""WITH {REFUNDS}, {DIMS}, rows_in AS (SELECT {at('s')} AS t, order_id, user_id,
          trademark_id AS tmk, category3_id AS c3k FROM refunds LEFT JOIN sku ON sku_id = sku.id),
        counted AS (SELECT {bucket('1 hour')}, tmk AS trademark_id, c3k AS category3_id, user_id,
          count(DISTINCT order_id) AS refund_count FROM rows_in GROUP BY ALL)
        SELECT stt, edt, trademark_id, trademark_name, category1_id, category1_name, c3.category2_id,
          category2_name, category3_id, category3_name, user_id, refund_count FROM counted {CHAIN}""",
    "watermark_late_drop": f"WITH {LATE.format(slack=0)} SELECT arrival, strftime(t, {SECOND}) AS event_time "
        "FROM marked WHERE late",
    "watermark_lateness": f"WITH {LATE.format(slack=1805)} SELECT {bucket('1 hour')}, count(*) AS n "
        "FROM marked WHERE NOT late GROUP BY ALL",
    "visitor_flag_crowded": f"WITH {VISITS}, {CROWD}, {REPAIRED.format(src='crowd')} "
        "SELECT event_id, mid, is_new FROM repaired",
    "count_once_crowded": f"""WITH {VISITS}, {CROWD}, seen AS (SELECT *, row_number() OVER (PARTITION BY mid
          ORDER BY t, event_id) AS rn FROM crowd)
        SELECT event_id, mid, CAST(CASE WHEN rn = 1 THEN 1 ELSE 0 END AS BIGINT) AS once FROM seen""",
    "retract_crowded": f"""WITH {VISITS}, {CROWD}, paired AS (SELECT mid, CAST(value AS DECIMAL(16,2)) AS a, page_id, t,
          event_id, lag(CAST(value AS DECIMAL(16,2))) OVER w AS p_a, lag(page_id) OVER w AS p_page, lag(t) OVER w AS p_t,
          lag(event_id) OVER w AS p_id FROM crowd WINDOW w AS (PARTITION BY mid ORDER BY t, event_id))
        SELECT mid AS id, CAST(CAST(a AS DECIMAL(18,2)) AS VARCHAR) AS amount, page_id, event_id, 1 AS sign,
          strftime(t, {SECOND}) AS event_time FROM paired
        UNION ALL SELECT mid, CAST(CAST(-p_a AS DECIMAL(18,2)) AS VARCHAR), p_page, p_id, -1,
          strftime(p_t, {SECOND}) FROM paired WHERE p_t IS NOT NULL""",
    "interval_join_crowded": f"""WITH {VISITS}, {CROWD} SELECT c.event_id, p.event_id AS purchase_id, c.mid
        FROM crowd c JOIN crowd p ON c.mid = p.mid AND c.event_type = 'click' AND p.event_type = 'purchase'
        AND c.t >= p.t - INTERVAL '1 hour' AND c.t <= p.t + INTERVAL '5 minutes'""",
    "order_users_crowded": f"WITH {VISITS}, {CROWD}, bought AS (SELECT * FROM crowd WHERE event_type = 'purchase'), "
        + user_days("bought", "mid", "payment_suc_unique_user_count", "payment_suc_new_user_count", "1 hour"),
    "keyword_table_function": f"""WITH w AS (SELECT p_partkey, unnest({TOKENS.format(text='p_name')}) AS word FROM part)
        SELECT p_partkey, word, count(*) AS n FROM w GROUP BY ALL""",
    "pay_detail_strict": f"WITH {PAID.format(good='AND p.good')} SELECT * FROM paid",
    "scalar_dates": f"""SELECT event_id, epoch_ms(date_trunc('second', ts)) AS full_ms,
        epoch_ms(date_trunc('day', ts)) AS day_ms, strftime(ts, '%Y-%m-%d') AS day,
        strftime(ts, {SECOND}) AS second, strftime(ts, '%Y-%m-%d') AS day_of_text,
        strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS yesterday, strftime(ts, {SECOND}) AS from_s,
        strftime(ts, {SECOND}) AS whole_s, strftime(ts - INTERVAL 15 MINUTE, {SECOND}) AS minus_15m,
        CAST(CAST(ts AS DATE) - DATE '2023-12-25' AS BIGINT) AS days FROM events""",
    "scalar_json": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
        CAST(NULL AS VARCHAR) AS missing, '{"a":"' || event_type || '"}' AS removed,
        '{"a":"' || event_type || '","b":' || user_id || ',"c":"x"}' AS added, 'y' AS replaced FROM events""",
    "scalar_strings": """SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type,
        p_name || '-' || p_brand AS joined, 'user_id,x' AS kept_keys, CAST(p_partkey AS VARCHAR) AS upper_key,
        CAST(len(string_split(p_name, ',')) AS BIGINT) AS parts,
        CAST(len(list_distinct(string_split(p_name, ' '))) AS BIGINT) AS distinct_words,
        contains(p_name, 'red') AS has_red FROM part""",
    "scalar_amounts": """WITH a AS (SELECT *, CASE WHEN l_linenumber = 3 THEN CAST(0 AS DECIMAL(16,2))
          ELSE CAST(l_extendedprice AS DECIMAL(16,2)) END AS m FROM lineitem)
        SELECT l_orderkey, l_linenumber, CAST(m AS VARCHAR) AS amount,
          CAST(CAST(-m AS DECIMAL(16,2)) AS VARCHAR) AS negated,
          CAST(CAST(m + CAST(l_tax AS DECIMAL(16,2)) AS DECIMAL(17,2)) AS VARCHAR) AS added,
          CASE WHEN l_quantity > 25 THEN 'big' ELSE 'small' END AS size,
          CAST(CASE WHEN l_linenumber = 3 THEN -1 ELSE l_quantity END AS BIGINT) AS whole FROM a""",
    "version_time_latest": f"""WITH {VISITS}, timed AS (SELECT mid, event_id, date_trunc('second', t)
          + CASE WHEN k % 2 = 0 THEN to_microseconds(CAST(rpad(CAST(k AS VARCHAR), 6, '0') AS BIGINT))
            ELSE INTERVAL 0 SECOND END AS vt FROM visits),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY vt DESC, event_id DESC) AS rn FROM timed)
        SELECT mid, event_id FROM ranked WHERE rn = 1""",
}
SQL |= {"job_cart_users": SQL["cart_uu_window"], "job_refund_users": SQL["refund_distinct_window"]}

assert set(SQL) <= set(QUERIES), set(SQL) - set(QUERIES)
