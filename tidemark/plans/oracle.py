"""DuckDB oracle SQL for the registered queries.

Each statement restates a query from the table rules (FIXTURES.md section 3)
in plain SQL over the pre-registered views, independently of the Spark code.
Shared derivations are CTE fragments composed per statement.
"""

from __future__ import annotations

from tidemark.plans import params as P

PREV_DAU_DATE = "2024-01-14"
PREV_ORDER_DATE = "1997-08-22"

EVID = """CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem'
  WHEN 'view' THEN 'addCart' WHEN 'error' THEN 'addComment' WHEN 'signup' THEN 'addFavor' END"""

STARTUP = """startup AS (
  SELECT CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid, 'gmall2019' AS appid,
    'area_' || CAST(user_id % 10 AS VARCHAR) AS area,
    CASE WHEN user_id % 10 < 3 THEN 'ios' ELSE 'andriod' END AS os,
    CASE WHEN user_id % 10 < 3 THEN 'appstore' ELSE 'ch_' || CAST(event_id % 7 AS VARCHAR) END AS ch,
    'startup' AS type, '1.1.' || CAST(event_id % 4 AS VARCHAR) AS vs,
    epoch_us(ts) // 1000 AS ts,
    strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d') AS logdate,
    strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%H') AS loghour
  FROM events)"""

DAU = """dau AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY logdate, mid
      ORDER BY ts, uid, appid, area, os, ch, type, vs, loghour) AS rn FROM startup) WHERE rn = 1)"""

DAU_SINK = """SELECT mid AS MID, uid AS UID, appid AS APPID, area AS AREA, os AS OS, ch AS CH,
  type AS TYPE, vs AS VS, logdate AS LOGDATE, loghour AS LOGHOUR, ts AS TS"""

CUTOFF_MS = f"(epoch_us(TIMESTAMP '{P.SEEN_CUTOFF}') // 1000)"

ORDERS = """orders_x AS (
  SELECT o.*, c.c_nationkey, c.c_name,
    o.o_orderdate + to_seconds((o.o_orderkey % 24) * 3600 + (o.o_orderkey * 7) % 3600) AS arrival
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
order_info AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS province_id,
    c_name AS consignee, o_orderpriority AS order_comment,
    '138' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS consignee_tel,
    o_orderstatus AS order_status, CAST(o_orderkey % 3 + 1 AS VARCHAR) AS payment_way,
    CAST(o_custkey AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS img_url,
    o_totalprice AS total_amount, CAST(NULL AS VARCHAR) AS expire_time,
    CAST(NULL AS VARCHAR) AS delivery_address,
    strftime(arrival, '%Y-%m-%d %H:%M:%S') AS create_time, CAST(NULL AS VARCHAR) AS operate_time,
    CAST(NULL AS VARCHAR) AS tracking_no, CAST(NULL AS VARCHAR) AS parent_order_id,
    CAST(NULL AS VARCHAR) AS out_trade_no, CAST(NULL AS VARCHAR) AS trade_body,
    arrival,
    strftime(arrival, '%Y-%m-%d') AS create_date, strftime(arrival, '%H') AS create_hour
  FROM orders_x)"""

DETAILS = """order_detail AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) || '_'
      || CAST(l.l_partkey AS VARCHAR) || '_' || CAST(l.l_suppkey AS VARCHAR) || '_'
      || CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS id,
    CAST(l.l_orderkey AS VARCHAR) AS order_id, p.p_name AS sku_name,
    CAST(l.l_partkey AS VARCHAR) AS sku_id,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS order_price,
    CAST(CAST(trunc(l.l_quantity) AS BIGINT) AS VARCHAR) AS sku_num,
    o.o_orderdate + to_seconds((l.l_orderkey % 24) * 3600 + (l.l_orderkey * 7) % 3600
      + ((l.l_partkey * 7) % 1201 - 600)) AS arrival
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

USER_CHANGES = """user_changes AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
    strftime(DATE '1940-01-01' + CAST((c_custkey * 37) % 27000 AS INTEGER), '%Y-%m-%d') AS birthday,
    CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, 'INSERT' AS event_type,
    TIMESTAMP '2023-06-01 00:00:00' + to_seconds(c_custkey) AS change_ts, c_custkey * 2 AS seq
  FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_name, c_mktsegment || '+',
    strftime(DATE '1940-01-01' + CAST((c_custkey * 37) % 27000 AS INTEGER), '%Y-%m-%d'),
    CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END, 'UPDATE',
    TIMESTAMP '2023-06-01 00:00:00' + to_seconds(c_custkey) + INTERVAL 1 DAY, c_custkey * 2 + 1
  FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'AUTOMOBILE')"""

LATEST_USER = """latest_user AS (
  SELECT id, login_name, user_level, birthday, gender FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY change_ts DESC, seq DESC) AS rn
    FROM user_changes WHERE event_type IN ('INSERT', 'UPDATE')) WHERE rn = 1)"""


def _sale_pairs(interval: bool) -> str:
    cond = ""
    if interval:
        cond = (f" AND d.arrival BETWEEN o.arrival - INTERVAL {P.JOIN_SECONDS} SECOND"
                f" AND o.arrival + INTERVAL {P.JOIN_SECONDS} SECOND")
    return f"""sale_pairs AS (
  SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id,
    d.sku_id, TRY_CAST(d.order_price AS DOUBLE) AS sku_price, d.sku_name, o.create_date AS dt
  FROM order_info o JOIN order_detail d ON o.id = d.order_id{cond})"""


SALES = f"""sales AS (
  SELECT s.order_detail_id, s.order_id, s.order_status, s.create_time, s.user_id, s.sku_id,
    u.gender AS user_gender,
    CAST(trunc(date_diff('day', CAST(u.birthday AS DATE), DATE '{P.AS_OF}') / 365.0) AS INTEGER) AS user_age,
    u.user_level, s.sku_price, s.sku_name, s.dt
  FROM sale_pairs s JOIN latest_user u ON s.user_id = u.id)"""

TOKENS = """list_filter(regexp_split_to_array(regexp_replace(lower({f}), '(\\p{{Han}})', ' \\1 ', 'g'),
  '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"""


def _tok(field: str) -> str:
    return TOKENS.format(f=field)


HITS = f"""hits AS (
  SELECT * FROM sales WHERE dt = '{P.ORDER_DATE}'
    AND list_contains({_tok('sku_name')}, '{P.KEYWORD}'))"""

SALE_CTES = ",\n".join([ORDERS, DETAILS, USER_CHANGES, LATEST_USER, _sale_pairs(True), SALES])

RANKED = f"""stats AS (
  SELECT CAST(count(*) AS DOUBLE) AS n_docs, avg(CAST(len({_tok('sku_name')}) AS DOUBLE)) AS avgdl,
    CAST(count(*) FILTER (WHERE list_contains({_tok('sku_name')}, '{P.KEYWORD}')) AS DOUBLE) AS df0
  FROM sales),
ranked AS (
  SELECT h.*, round(
    ln(1.0 + (st.n_docs - st.df0 + 0.5) / (st.df0 + 0.5))
    * tf * (1.2 + 1) / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / st.avgdl)), 6) AS score
  FROM (SELECT *, CAST(len(list_filter({_tok('sku_name')}, lambda x: x = '{P.KEYWORD}')) AS DOUBLE) AS tf,
          CAST(len({_tok('sku_name')}) AS DOUBLE) AS dl FROM hits) h, stats st)"""

EVENT_LOG = f"""event_log AS (
  SELECT json_extract_string(props, '$.k') AS mid, CAST(user_id AS VARCHAR) AS uid,
    {EVID} AS evid, CAST(event_id % 50 AS VARCHAR) AS itemid, epoch_us(ts) // 1000 AS ts
  FROM events)"""


def _alert_sql() -> str:
    slide = P.ALERT_SLIDE_S * 1000
    n = P.ALERT_WINDOW_S // P.ALERT_SLIDE_S
    length = P.ALERT_WINDOW_S * 1000
    ids = ["addFavor", "addComment", "addCart", "clickItem", "coupon"]
    counts = ",\n    ".join(f"count(*) FILTER (WHERE evid = '{e}') AS n_{e}" for e in ids)
    ev = ", ".join(f"CASE WHEN n_{e} > 0 THEN '{e}:' || CAST(n_{e} AS VARCHAR) END" for e in ids)
    return f"""{EVENT_LOG},
win AS (
  SELECT e.*, (e.ts // {slide}) * {slide} - i * {slide} AS w_start
  FROM event_log e, range(0, {n}) r(i)),
agg AS (
  SELECT mid, w_start,
    list_sort(list_distinct(list(uid) FILTER (WHERE evid = 'coupon' AND uid IS NOT NULL))) AS uids,
    list_sort(list_distinct(list(itemid) FILTER (WHERE evid = 'coupon' AND itemid IS NOT NULL))) AS itemids,
    count(*) AS event_count, bool_or(evid = 'clickItem') AS has_click,
    {counts}
  FROM win WHERE ts >= w_start AND ts < w_start + {length}
  GROUP BY mid, w_start),
alerts AS (
  SELECT mid,
    strftime(make_timestamp(w_start * 1000), '%Y-%m-%d %H:%M:%S') AS window_start,
    strftime(make_timestamp((w_start + {length}) * 1000), '%Y-%m-%d %H:%M:%S') AS window_end,
    array_to_string(uids, ',') AS uids, array_to_string(itemids, ',') AS itemids,
    concat_ws(',', {ev}) AS events, event_count
  FROM agg WHERE NOT coalesce(has_click, false) AND len(coalesce(uids, [])) >= {P.ALERT_MIN_UIDS})"""


CDC = """cdc AS (
  SELECT 'order_info' AS tbl, 'ROWDATA' AS entry_type, 'INSERT' AS event_type,
    json_object('id', id, 'province_id', province_id, 'consignee', consignee,
      'order_comment', order_comment, 'consignee_tel', consignee_tel, 'order_status', order_status,
      'payment_way', payment_way, 'user_id', user_id,
      'total_amount', CAST(CAST(total_amount AS DECIMAL(18,2)) AS VARCHAR),
      'create_time', create_time) AS after_json
  FROM order_info
  UNION ALL
  SELECT 'order_info', 'ROWDATA', 'DELETE', json_object('id', id) FROM order_info
  WHERE order_status = 'P'
  UNION ALL
  SELECT 'order_info', 'TRANSACTIONBEGIN', NULL, NULL FROM order_info WHERE order_comment = '1-URGENT'
  UNION ALL
  SELECT 'order_info', 'TRANSACTIONEND', NULL, NULL FROM order_info WHERE order_comment = '1-URGENT'
  UNION ALL
  SELECT 'payment_info', 'ROWDATA', 'INSERT', json_object('order_id', id) FROM order_info
  WHERE order_status = 'F'
  UNION ALL
  SELECT 'order_detail', 'ROWDATA', 'INSERT',
    json_object('id', id, 'order_id', order_id, 'sku_name', sku_name, 'sku_id', sku_id,
      'order_price', order_price, 'sku_num', sku_num) FROM order_detail
  UNION ALL
  SELECT 'user_info', 'ROWDATA', event_type,
    json_object('id', id, 'login_name', login_name, 'user_level', user_level,
      'birthday', birthday, 'gender', gender) FROM user_changes)"""


def _topic_records() -> str:
    return """topic_records AS (
  SELECT 'first' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
    CAST(event_id AS VARCHAR) AS key,
    CASE WHEN event_id % 2 = 0 THEN 'atguigu>>>' || props ELSE props END AS value,
    ts AS ts
  FROM events)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    dau_ctes = _with(STARTUP, DAU)
    q["dau_first_log"] = dau_ctes + DAU_SINK + " FROM dau"
    q["dau_incremental"] = _with(STARTUP, f"""batch AS (SELECT * FROM startup WHERE ts >= {CUTOFF_MS}),
seen AS (SELECT DISTINCT logdate, mid FROM startup WHERE ts < {CUTOFF_MS}),
fresh AS (SELECT * FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM seen s WHERE s.logdate = b.logdate AND s.mid = b.mid))""",
        """firsts AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY logdate, mid ORDER BY ts, uid, appid, area, os, ch, type, vs, loghour) AS rn
  FROM fresh) WHERE rn = 1)""") + DAU_SINK + " FROM firsts"
    q["dau_total"] = dau_ctes + f"SELECT count(*) AS dau FROM dau WHERE logdate = '{P.DAU_DATE}'"
    q["dau_by_hour"] = dau_ctes + (f"SELECT loghour, count(*) AS ct FROM dau WHERE logdate = "
                                   f"'{P.DAU_DATE}' GROUP BY loghour")
    q["dau_hours_compare"] = dau_ctes + f""", hours AS (SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hour FROM range(0, 24) t(h))
SELECT hours.hour,
  coalesce((SELECT count(*) FROM dau WHERE logdate = '{P.DAU_DATE}' AND loghour = hours.hour), 0) AS today,
  coalesce((SELECT count(*) FROM dau WHERE logdate = '{PREV_DAU_DATE}' AND loghour = hours.hour), 0) AS yesterday
FROM hours"""
    new_dev = "new_dev AS (SELECT logdate, count(*) AS new_devices FROM (SELECT mid, min(logdate) AS logdate FROM dau GROUP BY mid) GROUP BY logdate)"
    q["new_devices"] = _with(STARTUP, DAU, new_dev) + "SELECT logdate, new_devices FROM new_dev"
    q["pipeline_counts"] = _with(STARTUP, f"""batch AS (SELECT * FROM startup WHERE ts >= {CUTOFF_MS}),
seen AS (SELECT DISTINCT logdate, mid FROM startup WHERE ts < {CUTOFF_MS}),
fresh AS (SELECT * FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM seen s WHERE s.logdate = b.logdate AND s.mid = b.mid))""") + """
SELECT 1 AS step, 'raw' AS stage, (SELECT count(*) FROM batch) AS n
UNION ALL SELECT 2, 'after_seen_filter', (SELECT count(*) FROM fresh)
UNION ALL SELECT 3, 'after_batch_dedup', (SELECT count(*) FROM (SELECT DISTINCT logdate, mid FROM fresh))"""

    ord_ctes = _with(ORDERS)
    q["order_info_clean"] = ord_ctes + """SELECT id AS ID, province_id AS PROVINCE_ID, consignee AS CONSIGNEE,
  order_comment AS ORDER_COMMENT, substr(consignee_tel, 1, 4) || '*******' AS CONSIGNEE_TEL,
  order_status AS ORDER_STATUS, payment_way AS PAYMENT_WAY, user_id AS USER_ID, img_url AS IMG_URL,
  total_amount AS TOTAL_AMOUNT, expire_time AS EXPIRE_TIME, delivery_address AS DELIVERY_ADDRESS,
  create_time AS CREATE_TIME, operate_time AS OPERATE_TIME, tracking_no AS TRACKING_NO,
  parent_order_id AS PARENT_ORDER_ID, out_trade_no AS OUT_TRADE_NO, trade_body AS TRADE_BODY,
  create_date AS CREATE_DATE, create_hour AS CREATE_HOUR FROM order_info"""
    q["order_amount_total"] = ord_ctes + (f"SELECT round(sum(total_amount), 2) AS sum_amount FROM order_info "
                                          f"WHERE create_date = '{P.ORDER_DATE}'")
    q["order_amount_by_hour"] = ord_ctes + (f"SELECT create_hour, round(sum(total_amount), 2) AS sum_amount "
                                            f"FROM order_info WHERE create_date = '{P.ORDER_DATE}' GROUP BY create_hour")
    q["order_hours_compare"] = ord_ctes + f""", hours AS (SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hour FROM range(0, 24) t(h))
SELECT hours.hour,
  coalesce((SELECT round(sum(total_amount), 2) FROM order_info WHERE create_date = '{P.ORDER_DATE}' AND create_hour = hours.hour), 0.0) AS today,
  coalesce((SELECT round(sum(total_amount), 2) FROM order_info WHERE create_date = '{PREV_ORDER_DATE}' AND create_hour = hours.hour), 0.0) AS yesterday
FROM hours"""
    q["realtime_total"] = _with(STARTUP, DAU, new_dev, ORDERS) + f"""
SELECT 'dau' AS id, '新增日活' AS name, CAST((SELECT count(*) FROM dau WHERE logdate = '{P.DAU_DATE}') AS DOUBLE) AS value
UNION ALL SELECT 'new_mid', '新增设备', CAST(coalesce((SELECT sum(new_devices) FROM new_dev WHERE logdate = '{P.DAU_DATE}'), 0) AS DOUBLE)
UNION ALL SELECT 'order_amount', '新增交易额', (SELECT round(sum(total_amount), 2) FROM order_info WHERE create_date = '{P.ORDER_DATE}')"""
    prov = """prov AS (SELECT o.province_id, n.n_name AS province_name, round(sum(o.total_amount), 2) AS amount,
  count(*) AS order_count FROM order_info o LEFT JOIN nation n ON o.province_id = CAST(n.n_nationkey AS VARCHAR)
  GROUP BY o.province_id, n.n_name)"""
    q["province_amount"] = _with(ORDERS, prov) + "SELECT province_id, province_name, amount, order_count FROM prov"
    q["province_bands"] = _with(ORDERS, prov) + f"""SELECT band, CAST(band * {P.BAND_WIDTH} AS VARCHAR) || '-' || CAST((band + 1) * {P.BAND_WIDTH} AS VARCHAR) AS band_label,
  count(*) AS provinces FROM (SELECT CAST(floor(order_count / {P.BAND_WIDTH}) AS BIGINT) AS band FROM prov) GROUP BY band"""

    q["order_detail_outer"] = _with(ORDERS, DETAILS) + f"""SELECT coalesce(d.batch_id, o.batch_id) AS batch_id,
  coalesce(d.order_id, o.id) AS order_id, d.id AS order_detail_id, o.order_status, d.sku_id
FROM (SELECT id, order_status, (epoch_us(arrival) // 1000000) // {P.BATCH_SECONDS} AS batch_id FROM order_info) o
FULL OUTER JOIN (SELECT id, order_id, sku_id, (epoch_us(arrival) // 1000000) // {P.BATCH_SECONDS} AS batch_id FROM order_detail) d
ON o.id = d.order_id AND o.batch_id = d.batch_id"""
    q["sale_detail"] = _with(ORDERS, DETAILS, _sale_pairs(False)) + "SELECT * FROM sale_pairs"
    q["sale_detail_interval"] = _with(ORDERS, DETAILS, _sale_pairs(True)) + "SELECT * FROM sale_pairs"
    q["latest_user"] = _with(USER_CHANGES, LATEST_USER) + "SELECT * FROM latest_user"
    q["sale_detail_users"] = _with(SALE_CTES) + "SELECT * FROM sales"
    q["sale_search_total"] = _with(SALE_CTES, HITS) + "SELECT count(*) AS total FROM hits"
    start = (P.PAGE_NO - 1) * P.PAGE_SIZE
    q["sale_search_page"] = _with(SALE_CTES, HITS, RANKED) + (
        f"SELECT * EXCLUDE (tf, dl) FROM ranked ORDER BY score DESC, order_detail_id ASC "
        f"LIMIT {P.PAGE_SIZE} OFFSET {start}")
    q["sale_search_ranked"] = _with(SALE_CTES, HITS, RANKED) + "SELECT * EXCLUDE (tf, dl) FROM ranked"
    q["sale_gender_terms"] = _with(SALE_CTES, HITS) + """SELECT user_gender, count(*) AS doc_count FROM hits
WHERE user_gender IS NOT NULL GROUP BY user_gender ORDER BY doc_count DESC, user_gender ASC LIMIT 2"""
    q["sale_age_terms"] = _with(SALE_CTES, HITS) + """SELECT user_age, count(*) AS doc_count FROM hits
WHERE user_age IS NOT NULL GROUP BY user_age ORDER BY doc_count DESC, user_age ASC LIMIT 100"""
    pct = "CASE WHEN n = 0 THEN 0.0 ELSE floor({x} * 1000.0 / n + 0.5) / 10.0 END"
    q["sale_stat_gender"] = _with(SALE_CTES, HITS) + f"""SELECT '用户性别占比' AS title, name, value FROM (
  SELECT '男' AS name, {pct.format(x='m')} AS value FROM (SELECT count(*) AS n, count(*) FILTER (WHERE user_gender = 'M') AS m FROM hits)
  UNION ALL
  SELECT '女', {pct.format(x='f')} FROM (SELECT count(*) AS n, count(*) FILTER (WHERE user_gender = 'F') AS f FROM hits))"""
    q["sale_stat_age"] = _with(SALE_CTES, HITS) + f"""SELECT '用户年龄占比' AS title, name, value FROM (
  SELECT '20岁以下' AS name, {pct.format(x='b')} AS value FROM (SELECT count(*) AS n, count(*) FILTER (WHERE user_age < 20) AS b FROM hits)
  UNION ALL
  SELECT '20岁到30岁', {pct.format(x='b')} FROM (SELECT count(*) AS n, count(*) FILTER (WHERE user_age BETWEEN 20 AND 30) AS b FROM hits)
  UNION ALL
  SELECT '30岁以上', {pct.format(x='b')} FROM (SELECT count(*) AS n, count(*) FILTER (WHERE user_age > 30) AS b FROM hits))"""

    for name, same in (("realtime_total", "realtime_total"), ("new_devices", "new_devices"),
                       ("dau_hours", "dau_hours_compare"), ("order_hours", "order_hours_compare")):
        q[f"kept_{name}"] = q[same]              # kept totals answer as the tables do
    for name in ("total", "page", "ranked"):     # the kept index answers as the search does
        q[f"sale_index_{name}"] = q[f"sale_search_{name}"]
    q["sale_index_stat_age"] = q["sale_stat_age"]

    q["coupon_alert"] = "WITH " + _alert_sql() + "\nSELECT * FROM alerts"
    q["coupon_alert_keyed"] = "WITH " + _alert_sql() + """
SELECT doc_id, mid, window_start, window_end, uids, itemids, events, event_count FROM (
  SELECT *, mid || '_' || CAST((epoch_us(CAST(window_end AS TIMESTAMP)) // 1000) // 60000 AS VARCHAR) AS doc_id,
    row_number() OVER (PARTITION BY mid || '_' || CAST((epoch_us(CAST(window_end AS TIMESTAMP)) // 1000) // 60000 AS VARCHAR)
      ORDER BY window_end DESC, mid DESC, window_start DESC, uids DESC, itemids DESC, events DESC) AS rn
  FROM alerts) WHERE rn = 1"""

    q["cdc_route"] = _with(ORDERS, DETAILS, USER_CHANGES, CDC) + """SELECT CASE
    WHEN tbl = 'order_info' AND event_type = 'INSERT' THEN 'gmall_order_info'
    WHEN tbl = 'order_detail' AND event_type = 'INSERT' THEN 'gmall_order_detail'
    WHEN tbl = 'user_info' AND event_type IN ('INSERT', 'UPDATE') THEN 'gmall_user_info' END AS topic,
  CAST(after_json AS VARCHAR) AS value
FROM cdc WHERE entry_type = 'ROWDATA' AND (
  (tbl = 'order_info' AND event_type = 'INSERT') OR (tbl = 'order_detail' AND event_type = 'INSERT')
  OR (tbl = 'user_info' AND event_type IN ('INSERT', 'UPDATE')))"""
    q["log_route"] = f"""WITH lines AS (
  SELECT CASE WHEN event_type = 'signup' THEN 'startup' WHEN event_type = 'error' THEN NULL ELSE 'event' END AS type,
    CAST(user_id AS VARCHAR) AS mid, CAST(event_id AS VARCHAR) AS uid,
    CASE WHEN event_type = 'signup' THEN NULL ELSE {EVID} END AS evid,
    epoch_us(ts) // 1000 AS arrival FROM events)
SELECT CASE WHEN type = 'startup' THEN 'gmall_startup' ELSE 'gmall_event' END AS topic,
  CAST(CASE WHEN type IS NULL THEN json_object('mid', mid, 'uid', uid, 'evid', evid, 'ts', arrival)
       WHEN evid IS NULL THEN json_object('type', type, 'mid', mid, 'uid', uid, 'ts', arrival)
       ELSE json_object('type', type, 'mid', mid, 'uid', uid, 'evid', evid, 'ts', arrival) END AS VARCHAR) AS value,
  strftime(make_timestamp(arrival * 1000), '%Y-%m-%d') AS dt
FROM lines"""
    q["topic_strip"] = _with(_topic_records()) + """SELECT topic, "partition", "offset", key,
  regexp_replace(value, 'atguigu>>>', '', 'g') AS value FROM topic_records"""
    q["topic_transfer"] = _with(_topic_records()) + """SELECT 'second' AS topic, key,
  regexp_replace(value, 'atguigu>>>', '', 'g') AS value FROM topic_records"""
    q["log_counts"] = """SELECT topic, strftime(ts, '%Y-%m-%d %H') AS hour, count(*) AS logs
FROM events, (VALUES ('gmall_startup'), ('gmall_event')) AS t(topic) GROUP BY ALL"""
    q["value_time_prefix"] = _with(_topic_records()) + """SELECT topic, CAST(1 AS INTEGER) AS "partition", key,
  CAST(epoch_us(ts) // 1000 AS VARCHAR) || '-' || value AS value FROM topic_records"""
    q["topic_offset_range"] = _with(_topic_records()) + f"""SELECT "offset", value FROM (
  SELECT "offset", value, sum(coalesce(strlen(value), 0)) OVER (ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM topic_records WHERE topic = '{P.OFFSET_TOPIC}' AND "partition" = {P.OFFSET_PARTITION} AND "offset" >= {P.OFFSET_START})
WHERE upto <= {P.OFFSET_MAX_BYTES}"""
    q["topic_offset_kept"] = q["topic_offset_range"]
    q["delivery_counts"] = """SELECT count(*) FILTER (WHERE event_type <> 'error') AS success,
  count(*) FILTER (WHERE event_type = 'error') AS failure FROM events"""
    cells = """SELECT CAST(c_custkey AS VARCHAR) AS rowkey, 'hfile-fy' AS family, qualifier, value FROM (
  SELECT c_custkey, 'c_acctbal' AS qualifier, CAST(c_acctbal AS VARCHAR) AS value FROM customer
  UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer
  UNION ALL SELECT c_custkey, 'c_name', c_name FROM customer
  UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer)
WHERE value IS NOT NULL"""
    q["kv_cells"] = cells
    q["kv_cells_sorted"] = cells
    q["kv_cells_json"] = """SELECT CAST(c_custkey AS VARCHAR) AS rowkey, 'hfile-fy' AS family, qualifier, value FROM (
  SELECT c_custkey, 'c_acctbal' AS qualifier, CAST(c_acctbal AS VARCHAR) AS value FROM customer
  UNION ALL SELECT c_custkey, 'c_mktsegment', CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'AUTOMOBILE+' ELSE c_mktsegment END FROM customer
  UNION ALL SELECT c_custkey, 'c_name', c_name FROM customer
  UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey, 'c_level', CAST(c_custkey % 9 AS VARCHAR) FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
WHERE value IS NOT NULL"""
    q["keyed_upsert"] = _with(USER_CHANGES, LATEST_USER) + "SELECT * FROM latest_user"
    return q
