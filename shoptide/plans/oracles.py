"""The same results as ANSI SQL, written on their own and by the plainest route, for checking."""

from __future__ import annotations

from shoptide.operators import metrics
from shoptide.plans.bindings import DENSE_START, DENSITY
from shoptide.plans.queries import ALERT, AS_OF, DATE, FIRST_DATE, KEYWORD, PAGE, PAGE_SIZE, SALE_DATE
from shoptide.plans.reports import TOTALS, day_before

YESTERDAY = day_before(DATE)

STARTUP = """startup AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid, epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour
  FROM events)"""

DAU = STARTUP + """, dau AS (
  SELECT mid, log_date, log_hour, ts, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, event_id) AS rn FROM startup)
  WHERE rn = 1)"""

FIRST_SEEN = """first_seen AS (
  SELECT mid, min(ts) AS ts, min(log_date) AS log_date, strftime(make_timestamp(min(ts) * 1000), '%H') AS log_hour
  FROM startup GROUP BY mid)"""

EVENT_LOGS = """logs AS (
  SELECT event_id, CAST(user_id // 15 AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem' ELSE event_type END AS evid,
         json_extract_string(props, '$.k') AS itemid, epoch_us(ts) // 1000 AS ts
  FROM events)"""

TIMED_ORDERS = """timed AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, value AS total_amount,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, strftime(ts, '%Y-%m-%d') AS create_date,
         strftime(ts, '%H') AS create_hour, '13' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS tel
  FROM events WHERE event_type = 'purchase')"""

ORDERS = """shop_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS order_status,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time, strftime(o_orderdate, '%Y-%m-%d') AS dt,
         CAST(o_custkey AS VARCHAR) AS user_id
  FROM orders)"""

ITEMS = """items AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_detail_id,
         CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id, p_name AS sku_name,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS order_price,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS sku_num, l_linenumber, l_orderkey
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

UNIQUE_ITEMS = """unique_items AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_id, order_detail_id
      ORDER BY sku_name NULLS FIRST, sku_id, CAST(order_price AS DOUBLE)) AS rn
    FROM items)
  WHERE rn = 1)"""

USERS = f"""users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, CAST(c_custkey % 3 + 1 AS VARCHAR) AS user_level,
         strftime(DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CAST((DATE '{AS_OF}' - (DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER))) // 365 AS INTEGER) AS age,
         c_acctbal
  FROM customer)"""

DESCRIBED = """described AS (
  SELECT sku_id, sku_name, string_split(replace(sku_name, ',', ''), ' ') AS words FROM (
    SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_name || CASE WHEN p_partkey % 3 = 0 THEN ' red plate' ELSE '' END
           || CASE WHEN p_partkey % 5 = 0 THEN ' for the old kitchen, red' ELSE '' END AS sku_name FROM part))"""

SALES = f"""{ORDERS}, {ITEMS}, {UNIQUE_ITEMS}, {USERS}, sales AS (
  SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id, gender AS user_gender,
         coalesce(age, 0) AS user_age, user_level, CAST(order_price AS DOUBLE) AS sku_price, sku_name, dt,
         users.id IS NOT NULL AS user_known, l_linenumber
  FROM unique_items JOIN shop_orders USING (order_id) LEFT JOIN users ON users.id = user_id)"""

SALE_COLUMNS = (
    "order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender, user_age, "
    "user_level, sku_price, sku_name, dt, user_known"
)

FEED = """feed AS (
  SELECT 'order_info' AS tbl, o_orderkey % 3 AS k, CAST(o_orderkey AS VARCHAR) AS row_id, 1 AS n_rows,
         ['{"id":"' || o_orderkey || '","user_id":"' || o_custkey || '","total_amount":"'
          || CAST(o_totalprice AS DECIMAL(18,2)) || '"}'] AS msgs
  FROM orders WHERE o_orderkey % 5 <> 0
  UNION ALL
  SELECT 'order_detail', l_orderkey % 3, l_orderkey || '-' || l_linenumber, 1,
         ['{"id":"' || l_orderkey || '-' || l_linenumber || '","order_id":"' || l_orderkey || '","sku_id":"' || l_partkey
          || '","order_price":"' || CAST(l_extendedprice AS DECIMAL(18,2)) || '"}']
  FROM lineitem
  UNION ALL
  SELECT 'user_info', c_custkey % 3, CAST(c_custkey AS VARCHAR), 2,
         ['{"id":"' || c_custkey || '","user_level":"1"}', '{"id":"' || c_custkey || '","user_level":"2"}']
  FROM customer
  UNION ALL
  SELECT 'base_province', 0, CAST(n_nationkey AS VARCHAR), 1, ['{"id":"' || n_nationkey || '"}'] FROM nation),
routed AS (
  SELECT tbl AS topic, CASE k WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' ELSE 'DELETE' END AS event_type, row_id, n_rows, msgs
  FROM feed
  WHERE (tbl IN ('order_info', 'order_detail') AND k = 0) OR (tbl = 'user_info' AND k IN (0, 1)))"""

DEVICE = """device AS (
  SELECT CASE WHEN event_type = 'signup' THEN 'startup_log' ELSE 'event_log' END AS topic,
         '{"mid":"' || user_id || '",'
         || CASE event_type WHEN 'signup' THEN '"type":"startup",' WHEN 'error' THEN '' ELSE '"type":"event",' END
         || CASE WHEN event_id % 11 = 3 THEN '"price":1.5' ELSE '"price":1.50' END || ',"serial":123456789012345678901234567890,"body":'
         || CASE WHEN event_id % 11 = 3 THEN replace(props, ': ', ':') || ',"more":{"ts":5}' ELSE props END || ',"ts":' || epoch_us(ts) // 1000 || '}' AS value,
         strftime(ts, '%Y-%m-%d') AS log_date
  FROM events WHERE event_id % 17 NOT IN (4, 5))"""

SIZE, SLIDE, K = ALERT["size_ms"], ALERT["slide_ms"], ALERT["accounts"]


def _alerts(logs: str, size: int, slide: int, accounts: int) -> str:
    return f"""WITH {logs}, placed AS (
  SELECT logs.*, unnest(range(ts // {slide} * {slide} + {slide}, ts // {slide} * {slide} + {size} + 1, {slide})) AS window_end
  FROM logs), verdict AS (
  SELECT mid, window_end,
         string_agg(DISTINCT uid, ',' ORDER BY uid) FILTER (evid = 'coupon') AS uids,
         string_agg(DISTINCT itemid, ',' ORDER BY itemid) FILTER (evid = 'coupon') AS item_ids,
         string_agg(evid, ',' ORDER BY ts, event_id) AS events
  FROM placed GROUP BY mid, window_end
  HAVING count(DISTINCT uid) FILTER (evid = 'coupon') >= {accounts} AND NOT bool_or(evid = 'clickItem')), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY mid, window_end // 60000 ORDER BY window_end DESC) AS rn FROM verdict)
SELECT mid || '_' || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M') AS doc_id, mid, uids, item_ids, events,
       window_end AS ts, strftime(make_timestamp(window_end * 1000), '%Y-%m-%d') AS dt
FROM ranked WHERE rn = 1"""


ALERTS = _alerts(EVENT_LOGS, SIZE, SLIDE, K)
# The same events two hundred times as dense, for windows of minutes.
DENSE_LOGS = EVENT_LOGS.replace("epoch_us(ts) // 1000 AS ts", f"{DENSE_START} + (epoch_us(ts) // 1000 - {DENSE_START}) // {DENSITY} AS ts")

ALERT_PARTS = f"""WITH alerts AS ({ALERTS}), {EVENT_LOGS}, inside AS (
  SELECT doc_id, logs.ts // {SLIDE} * {SLIDE} AS pane, logs.ts AS said, event_id, evid
  FROM alerts JOIN logs ON logs.mid = alerts.mid AND logs.ts >= alerts.ts - {SIZE} AND logs.ts < alerts.ts), numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY doc_id, pane ORDER BY said, event_id) - 1) // 2 AS part FROM inside)
SELECT doc_id, pane, part, string_agg(evid, ',' ORDER BY said, event_id) AS events FROM numbered GROUP BY doc_id, pane, part"""

DAU_ROWS = f"WITH {DAU} SELECT mid, log_date, log_hour, ts, event_id FROM dau"


def _percent(part: str, total: str) -> str:
    return f"coalesce(floor({part} * 1000.0 / nullif({total}, 0) + 0.5) / 10, 0.0)"


BANDS = {"under_20": "user_age < 20", "from_20": "user_age >= 20 AND user_age < 30", "from_30": "user_age >= 30"}
GENDERS = {"male": "user_gender = 'M'", "female": "user_gender = 'F'"}


def _shares(labels: dict[str, str], tests: dict[str, str], source: str = "sales") -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS name, {_percent(f'count(*) FILTER ({tests[key]})', 'count(*)')} AS value FROM {source}"
        for key, label in labels.items()
    )


def _report() -> str:
    stats = []
    for title, labels, tests in (
        (metrics.AGE_TITLE, metrics.AGE_OPTIONS, BANDS),
        (metrics.GENDER_TITLE, metrics.GENDER_OPTIONS, GENDERS),
    ):
        for key, label in labels.items():
            share = _percent(f"count(*) FILTER ({tests[key]})", "count(*)")
            stats.append(f"SELECT 'stat' AS section, '{title}' AS title, '{label}' AS name, {share} AS value, NULL AS detail FROM hits")
    shown = ["order_detail_id", "order_id", "user_id", "user_gender", "user_age", "user_level", "sku_id", "sku_name", "dt"]
    body = ' || \',"'.join(
        f"{c}\":' || user_age" if c == "user_age" else f"{c}\":\"' || {c} || '\"'" for c in shown
    )
    return f"""WITH {SALES}, hits AS (SELECT * FROM sales WHERE {HIT})
SELECT 'total' AS section, NULL AS title, 'total' AS name, CAST(count(*) AS DOUBLE) AS value, NULL AS detail FROM hits
UNION ALL {' UNION ALL '.join(stats)}
UNION ALL SELECT * FROM (
  SELECT 'detail', NULL, order_id || '-' || order_detail_id, sku_price, '{{"{body} || '}}'
  FROM hits ORDER BY order_id, order_detail_id LIMIT 20)"""


HIT = f"dt = '{SALE_DATE}' AND list_contains(regexp_extract_all(lower(sku_name), '[\\p{{L}}\\p{{N}}_]+'), '{KEYWORD}')"


def _hours(dates: tuple[str, ...]) -> str:
    return f"""WITH {DAU}, spine AS (
  SELECT d AS log_date, lpad(CAST(h AS VARCHAR), 2, '0') AS hour
  FROM (SELECT unnest({list(dates)!r}) AS d), (SELECT unnest(range(24)) AS h)), hourly AS (
  SELECT log_date, log_hour AS hour, count(*) AS n FROM dau GROUP BY ALL)
SELECT log_date, hour, coalesce(n, 0) AS value FROM spine LEFT JOIN hourly USING (log_date, hour)"""


CENTS = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"
MASK = "substr({0}, 1, 3) || '****' || substr({0}, 8)"

ORACLES: dict[str, str] = {
    "decode_json": f"""WITH {EVENT_LOGS}, msg AS (
  SELECT *, evid = 'error' AS bad, '{{"mid":"' || mid || '","uid":"' || uid || '","evid":"' || evid AS head FROM logs)
SELECT event_id, CASE WHEN NOT bad THEN mid END AS mid, CASE WHEN NOT bad THEN uid END AS uid, CAST(NULL AS VARCHAR) AS os,
       CASE WHEN NOT bad THEN evid END AS evid, CASE WHEN NOT bad THEN itemid END AS itemid,
       CASE WHEN NOT bad THEN ts END AS ts, bad AS malformed, CASE WHEN bad THEN substr(head, 1, 20) END AS raw
FROM msg""",
    "cdc_route": f"WITH {FEED} SELECT topic, event_type, row_id, n_rows FROM routed",
    "cdc_flatten": f"WITH {FEED} SELECT topic, unnest(msgs) AS value FROM routed",
    "log_route": f"WITH {DEVICE} SELECT topic, value FROM device",
    "log_archive": f"WITH {DEVICE} SELECT log_date, value FROM device",
    "log_time": f"WITH {STARTUP} SELECT event_id, mid, log_date, log_hour FROM startup",
    "order_time": f"WITH {TIMED_ORDERS} SELECT id, create_time, create_date, create_hour FROM timed",
    "mask_phone": f"""SELECT id, {MASK.format('tel')} AS consignee_tel FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, '13' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS tel FROM orders)""",
    "doc_id": f"""WITH {STARTUP}
SELECT mid || '_' || log_date AS doc_id FROM startup
UNION ALL SELECT user_id || '_' || strftime(ts, '%Y-%m-%d %H:%M') FROM events
UNION ALL SELECT l_orderkey || '-' || l_linenumber FROM lineitem""",
    "user_age": f"WITH {USERS} SELECT id, birthday, age AS user_age FROM users",
    "user_latest": f"""WITH {USERS}
SELECT id, login_name, CASE WHEN c_acctbal > 5000 THEN '9' ELSE user_level END AS user_level, birthday, gender,
       CASE WHEN c_acctbal > 5000 THEN 2 ELSE 1 END AS version FROM users""",
    "user_stream": f"""WITH {USERS}
SELECT id, login_name, CASE WHEN c_acctbal > 5000 THEN '9' ELSE user_level END AS user_level, birthday, gender FROM users""",
    "dau_unseen": f"""WITH {STARTUP}
SELECT event_id, mid, log_date, log_hour, ts FROM startup a
WHERE log_hour >= '12' AND NOT EXISTS (
  SELECT 1 FROM startup b WHERE b.mid = a.mid AND b.log_date = a.log_date AND b.log_hour < '12')""",
    "dau_first": DAU_ROWS,
    "dau_stream": DAU_ROWS,
    "dau_stage_counts": f"""WITH {STARTUP}, late AS (SELECT * FROM startup WHERE log_hour >= '12'), fresh AS (
  SELECT * FROM late WHERE (mid, log_date) NOT IN (SELECT (mid, log_date) FROM startup WHERE log_hour < '12'))
SELECT 'input' AS stage, count(*) AS n FROM late
UNION ALL SELECT 'after_unseen', count(*) FROM fresh
UNION ALL SELECT 'after_first', count(*) FROM (SELECT DISTINCT mid, log_date FROM fresh)""",
    "dau_total": f"SELECT count(DISTINCT user_id) AS value FROM events WHERE strftime(ts, '%Y-%m-%d') = '{DATE}'",
    "dau_hours": f"""WITH {DAU}
SELECT log_date, log_hour AS hour, count(*) AS value FROM dau WHERE log_date = '{DATE}' GROUP BY ALL""",
    "new_mid_stream": f"WITH {STARTUP}, {FIRST_SEEN} SELECT mid, ts, log_date, log_hour FROM first_seen",
    "gmv_hours_stream": f"""WITH {TIMED_ORDERS}
SELECT create_date, create_hour AS hour, round(CAST(sum(CAST(total_amount AS DECIMAL(28,10)) * CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 2 ELSE 1 END) AS DOUBLE), 2) AS value, count(*) AS orders
FROM timed GROUP BY ALL""",
    "new_mid_total": f"WITH {STARTUP}, {FIRST_SEEN} SELECT count(*) AS value FROM first_seen WHERE log_date = '{FIRST_DATE}'",
    "new_mid_hours": f"""WITH {STARTUP}, {FIRST_SEEN}
SELECT log_date, log_hour AS hour, count(*) AS value FROM first_seen WHERE log_date = '{FIRST_DATE}' GROUP BY ALL""",
    "gmv_total": f"WITH {TIMED_ORDERS} SELECT {CENTS.format('total_amount')} AS value FROM timed WHERE create_date = '{DATE}'",
    "gmv_hours": f"""WITH {TIMED_ORDERS}
SELECT create_date, create_hour AS hour, {CENTS.format('total_amount')} AS value
FROM timed WHERE create_date = '{DATE}' GROUP BY ALL""",
    "gmv_stream": f"""WITH {TIMED_ORDERS}
SELECT id, user_id, total_amount, create_date, create_hour, {MASK.format('tel')} AS consignee_tel FROM timed""",
    "hours_filled": _hours((DATE, YESTERDAY)),
    "sales_by_province": f"""SELECT CAST(c_nationkey AS VARCHAR) AS province_id, count(*) AS orders, {CENTS.format('o_totalprice')} AS amount
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""",
    "realtime_total": f"""WITH {DAU}, {FIRST_SEEN}, {TIMED_ORDERS}
SELECT 'dau' AS id, '{TOTALS["dau"]}' AS name, CAST(count(*) AS DOUBLE) AS value FROM dau WHERE log_date = '{FIRST_DATE}'
UNION ALL SELECT 'new_mid', '{TOTALS["new_mid"]}', count(*) FROM first_seen WHERE log_date = '{FIRST_DATE}'
UNION ALL SELECT 'order_amount', '{TOTALS["order_amount"]}', {CENTS.format('total_amount')} FROM timed WHERE create_date = '{FIRST_DATE}'""",
    "realtime_hours": f"""WITH {DAU}, {TIMED_ORDERS}
SELECT 'dau' AS id, CASE log_date WHEN '{DATE}' THEN 'today' ELSE 'yesterday' END AS label, log_hour AS hour,
       CAST(count(*) AS DOUBLE) AS value
FROM dau WHERE log_date IN ('{DATE}', '{YESTERDAY}') GROUP BY ALL
UNION ALL
SELECT 'order_amount', CASE create_date WHEN '{DATE}' THEN 'today' ELSE 'yesterday' END, create_hour, {CENTS.format('total_amount')}
FROM timed WHERE create_date IN ('{DATE}', '{YESTERDAY}') GROUP BY ALL""",
    "order_detail_join": f"""WITH {ORDERS}, {ITEMS}
SELECT order_id, order_detail_id, sku_id, sku_name, CAST(order_price AS DOUBLE) AS sku_price, order_status, create_time, dt, user_id
FROM items JOIN shop_orders USING (order_id)""",
    "order_detail_full_outer": f"""WITH {ORDERS}, {ITEMS}
SELECT coalesce(i.order_id, o.order_id) AS order_id, order_detail_id,
       CASE WHEN i.order_id IS NULL THEN 'order_only' WHEN o.order_id IS NULL THEN 'detail_only' ELSE 'both' END AS match_status
FROM items i FULL OUTER JOIN shop_orders o ON i.order_id = o.order_id""",
    "order_detail_interval_join": """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS order_id, l_orderkey || '-' || l_linenumber AS order_detail_id
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_linenumber * 40 <= 120""",
    "sale_detail": f"WITH {SALES} SELECT {SALE_COLUMNS} FROM sales",
    "sale_detail_stream": f"""WITH {SALES}
SELECT order_id || '-' || order_detail_id AS doc_id, {SALE_COLUMNS} FROM sales WHERE l_linenumber * 40 <= 120""",
    "keyword_match": f"""SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_name AS sku_name FROM part
WHERE list_contains(string_split(lower(p_name), ' '), '{KEYWORD}')""",
    "keyword_match_all": """SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_name || ' 红色 手机' AS sku_name FROM part
WHERE p_partkey % 2 = 0 AND list_contains(string_split(lower(p_name), ' '), 'bolt')""",
    "keyword_relevance": f"""WITH {DESCRIBED}, stat AS (
  SELECT count(*) AS n, avg(len(words)) AS length, count(*) FILTER (list_contains(words, 'plate')) AS plates, count(*) FILTER (list_contains(words, 'red')) AS reds FROM described), hits AS (
  SELECT sku_id, sku_name, len(words) AS size, len(list_filter(words, lambda w: w = 'plate')) AS plate, len(list_filter(words, lambda w: w = 'red')) AS red FROM described)
SELECT sku_id, sku_name, round(ln(1 + (n - plates + 0.5) / (plates + 0.5)) * plate * 2.2 / (plate + 1.2 * (0.25 + 0.75 * size / length))
     + ln(1 + (n - reds + 0.5) / (reds + 0.5)) * red * 2.2 / (red + 1.2 * (0.25 + 0.75 * size / length)), 6) AS score
FROM hits, stat WHERE plate > 0 AND red > 0""",
    "keyword_index": f"""WITH {DESCRIBED} SELECT sku_id, sku_name FROM described WHERE list_contains(words, 'red') AND list_contains(words, 'kitchen')""",
    "sale_detail_deep_page": """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_orderkey || '-' || l_linenumber AS id, CAST(l_partkey AS VARCHAR) AS sku_id,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS order_price
FROM lineitem ORDER BY order_id, id, sku_id, order_price LIMIT 200 OFFSET 20000""",
    "gender_terms": f"""WITH {SALES} SELECT user_gender, count(*) AS n FROM sales
WHERE user_gender IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 2""",
    "age_terms": f"WITH {SALES} SELECT user_age, count(*) AS n FROM sales GROUP BY 1 ORDER BY n DESC, 1 LIMIT 100",
    "gender_share": f"WITH {SALES} {_shares(metrics.GENDER_OPTIONS, GENDERS)}",
    "age_share": f"WITH {SALES} {_shares(metrics.AGE_OPTIONS, BANDS)}",
    "sale_detail_page": f"""WITH {SALES} SELECT {SALE_COLUMNS} FROM sales WHERE {HIT}
ORDER BY order_id, order_detail_id LIMIT {PAGE_SIZE} OFFSET {(PAGE - 1) * PAGE_SIZE}""",
    "sale_detail_report": _report(),
    "coupon_alert": ALERTS,
    "coupon_alert_stream": ALERTS,
    "coupon_alert_live": _alerts(DENSE_LOGS, 300_000, 5_000, 3),
    "coupon_alert_parts": ALERT_PARTS,
    "document_stream": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, event_id % 2 = 1 AS generated FROM events",
    "word_count": """WITH lines AS (
  SELECT text FROM documents UNION ALL SELECT text FROM conversations), pieces AS (
  SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM lines WHERE text = '' OR rtrim(text, ' ') <> '')
SELECT word, count(*) AS n FROM pieces GROUP BY word""",
    "fold_lengths": """WITH per_source AS (
  SELECT source, list_reduce(list(text ORDER BY doc_id), lambda acc, x: CAST(greatest(length(acc), length(x)) AS VARCHAR), '0') AS folded
  FROM documents GROUP BY source)
SELECT '0' || string_agg(folded, '' ORDER BY source) AS folded FROM per_source""",
    "observed_sum": f"SELECT {CENTS.format('value')} AS total FROM events",
}
