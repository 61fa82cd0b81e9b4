"""The queries of the catalog as SQL over the same tables, to check them with."""

from __future__ import annotations

from tillwatch.catalog import (
    AS_OF, CURVE_DAY, DELIVERED, HAN_KEYWORD, HAN_WORDS, JOIN_SECONDS, KEPT_DAY, PAGE_SIZE, PAGED, REPORT_DAY, REPORT_WORD, REPORT_WORDS, SEARCH,
)
from tillwatch.records import AGE_LABELS, AGE_TITLE, FEMALE_LABEL, GENDER_TITLE, KPI_NAMES, MALE_LABEL

LOGS = """
logs AS (
  SELECT event_id, ts AS event_at, CAST(user_id AS VARCHAR) AS mid, json_extract_string(props, '$.k') AS uid,
         CASE WHEN event_type = 'signup' THEN 'startup' ELSE 'event' END AS type,
         event_type AS evid,
         CAST(event_id AS VARCHAR) AS itemid, strftime(ts, '%Y-%m-%d') AS logDate, strftime(ts, '%H') AS logHour,
         epoch_us(ts) // 1000 AS ts, CAST(value AS DECIMAL(18,2)) AS value
  FROM events)"""

ACTIVE = LOGS + """,
active AS (
  SELECT logDate, mid, uid, logHour, ts, event_id FROM logs
  QUALIFY row_number() OVER (PARTITION BY logDate, mid ORDER BY ts, event_id) = 1)"""

LINES = LOGS + """,
lines AS (
  SELECT *, '{"type":"' || type || '","mid":"' || mid || '","uid":"' || uid || '","evid":"' || evid
            || '","itemid":' || itemid || ',"at":{"pgid":' || event_id % 50 || ',"who":{"id":"' || uid || '"}},"ts":' || ts || '}' AS line
  FROM logs)"""

USERS = f"""
users AS (
  SELECT *, CAST((epoch_ms(TIMESTAMP '{AS_OF}') - epoch_ms(CAST(birthday AS TIMESTAMP))) // 31536000000 AS INTEGER) AS age
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
               strftime(DATE '2001-08-01' - CAST((c_custkey % 40 + 10) * 365 AS INTEGER), '%Y-%m-%d') AS birthday,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
        FROM customer))"""

ORDERS = """
o AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS order_status,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour, o_orderdate AS order_at
  FROM orders)"""

DETAILS = """
d AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS sku_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS order_price,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS sku_num, p_name AS sku_name, l_returnflag, l_shipdate AS detail_at
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

SALES = f"{USERS},{ORDERS},{DETAILS}," + """
sales AS (
  SELECT o.id || '-' || d.id AS doc_id, d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time,
         o.user_id, d.sku_id, users.gender AS user_gender, coalesce(users.age, 0) AS user_age, users.user_level,
         CAST(d.order_price AS DOUBLE) AS sku_price, d.sku_name, o.create_date AS dt, o.order_at, d.detail_at
  FROM (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY order_id, id ORDER BY order_price DESC) = 1) d
  JOIN o ON o.id = d.order_id LEFT JOIN users ON users.id = o.user_id)"""

SALE_COLUMNS = (
    "doc_id, order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender, user_age, user_level, "
    "sku_price, sku_name, dt"
)

ROUTED = f"{USERS},{ORDERS},{DETAILS}," + """
routed AS (
  SELECT 'order_info' AS topic, '{"id":"' || id || '","user_id":"' || user_id || '","order_status":"' || order_status
         || '","total_amount":"' || total_amount || '","create_time":"' || create_time || '"}' AS value
  FROM o WHERE order_status = 'O'
  UNION ALL
  SELECT 'order_detail', '{"id":"' || id || '","order_id":"' || order_id || '","sku_id":"' || sku_id
         || '","order_price":"' || order_price || '","sku_num":"' || sku_num || '"}'
  FROM d WHERE l_returnflag = 'N'
  UNION ALL
  SELECT 'user_info', '{"id":"' || id || '","login_name":"' || login_name || '","user_level":"' || user_level
         || '","birthday":"' || birthday || '","gender":"' || gender || '"}'
  FROM users)"""

WINDOWS = LOGS + """,
spread AS (
  SELECT *, time_bucket(INTERVAL 6 HOURS, event_at, TIMESTAMP '1970-01-01') - k.i * INTERVAL 6 HOURS AS ws
  FROM logs, generate_series(0, 11) AS k(i)),
windows AS (
  SELECT ws, mid, count(DISTINCT CASE WHEN evid = 'purchase' THEN uid END) AS n_users
  FROM spread GROUP BY ws, mid
  HAVING count(DISTINCT CASE WHEN evid = 'purchase' THEN uid END) >= 3 AND NOT bool_or(evid = 'click')),
throttled AS (
  SELECT *, strftime(ws + INTERVAL 3 DAYS - INTERVAL 1 MICROSECOND, '%Y-%m-%d') AS day FROM windows
  QUALIFY row_number() OVER (PARTITION BY mid, strftime(ws + INTERVAL 3 DAYS - INTERVAL 1 MICROSECOND, '%Y-%m-%d')
                             ORDER BY ws DESC) = 1)"""

# The windows that a stream has closed: its watermark trails the last event by the lateness allowed.
WINDOWS_OVER = WINDOWS.replace(
    "FROM spread GROUP BY ws, mid", "FROM spread WHERE ws + INTERVAL 3 DAYS <= (SELECT max(event_at) FROM logs) - INTERVAL 1 HOUR GROUP BY ws, mid"
)

ALERT_EVENTS = """
found AS (
  SELECT t.mid, t.day, t.ws, s.uid, CAST(s.event_id % 5 AS VARCHAR) AS itemid, s.evid, s.ts,
         t.mid || '_' || (epoch_ms(CAST(t.day AS TIMESTAMP)) // 60000) AS doc_id
  FROM throttled t JOIN spread s ON s.ws = t.ws AND s.mid = t.mid)"""

ALERT_LISTS = """
SELECT doc_id, mid, string_agg(DISTINCT uid, ',' ORDER BY uid) FILTER (WHERE evid = 'purchase') AS uids,
       string_agg(DISTINCT itemid, ',' ORDER BY itemid) FILTER (WHERE evid = 'purchase') AS itemIds,
       string_agg(evid, ',' ORDER BY ts, evid) AS events, epoch_us(ws + INTERVAL 3 DAYS - INTERVAL 1 MICROSECOND) // 1000 AS ts
FROM found GROUP BY doc_id, mid, ws"""


def _compare(source: str, value: str) -> str:
    return f""",
hourly AS ({source}),
spine AS (SELECT DISTINCT day, lpad(CAST(k.i AS VARCHAR), 2, '0') AS hour FROM hourly, generate_series(0, 23) AS k(i))
SELECT s.day, s.hour, coalesce(t.v, 0) AS today, coalesce(y.v, 0) AS yesterday FROM spine s
LEFT JOIN hourly t ON t.day = s.day AND t.hour = s.hour
LEFT JOIN hourly y ON y.day = strftime(CAST(s.day AS DATE) - 1, '%Y-%m-%d') AND y.hour = s.hour"""


def _bm25(rows: str, id_column: str, text: str, keyword: str) -> str:
    words = keyword.split()
    df = ", ".join(f"count(*) FILTER (WHERE list_contains(bag, '{w}')) AS df{i}" for i, w in enumerate(words))
    score = " + ".join(
        f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * len(list_filter(bag, lambda t: t = '{w}')) * 2.2 "
        f"/ (len(list_filter(bag, lambda t: t = '{w}')) + 1.2 * (0.25 + 0.75 * len(bag) / avg_len))"
        for i, w in enumerate(words)
    )
    return f"""
bags AS (SELECT {id_column} AS id, list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'),
                                               lambda t: t <> '') AS bag FROM {rows}),
stats AS (SELECT count(*) AS n, avg(len(bag)) AS avg_len, {df} FROM bags),
scores AS (SELECT id, round({score}, 6) AS score FROM bags, stats WHERE list_has_any(bag, {words}))"""


def _matching(words: str, how: str) -> str:
    return f"""
SELECT p_partkey, p_name{{extra}} FROM part
WHERE {how}(regexp_split_to_array(lower(p_name), '[^\\p{{{{L}}}}\\p{{{{N}}}}]+'), {words.split()})"""


def _han(name: str) -> str:
    for word, han in HAN_WORDS.items():
        name = f"replace({name}, '{word}', '{han}')"
    return name


def oracle_sql() -> dict[str, str]:
    low = "count(*) FILTER (WHERE user_age < 20)"
    mid = "count(*) FILTER (WHERE user_age BETWEEN 20 AND 29)"
    women = "count(*) FILTER (WHERE user_gender = 'F')"

    def cut(part: str) -> str:
        return f"floor({part} * 1000 / nullif(count(*), 0)) / 10"

    labels = [
        (AGE_TITLE, 0, AGE_LABELS[0], cut(low)),
        (AGE_TITLE, 1, AGE_LABELS[1], cut(mid)),
        (AGE_TITLE, 2, AGE_LABELS[2], f"round(100 - {cut(low)} - {cut(mid)}, 1)"),
        (GENDER_TITLE, 0, MALE_LABEL, f"round(100 - {cut(women)}, 1)"),
        (GENDER_TITLE, 1, FEMALE_LABEL, cut(women)),
    ]
    hits = f"hits AS (SELECT * FROM sales WHERE dt = '{REPORT_DAY}' AND list_contains(string_split(sku_name, ' '), '{REPORT_WORD}'))"
    day_sales = f"day_sales AS (SELECT * FROM sales WHERE dt = '{REPORT_DAY}')"
    dau = f"""WITH {ACTIVE} SELECT * FROM active"""
    alert_rows = f"""WITH {WINDOWS}
SELECT day, mid, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, n_users FROM throttled"""
    amount_by_day = f"""WITH {ORDERS}
SELECT create_date, CAST(sum(total_amount) AS DOUBLE) AS amount FROM o GROUP BY create_date"""
    purchases = "SELECT * FROM logs WHERE evid = 'purchase'"
    user_latest = """SELECT o_custkey AS id, o_orderpriority AS user_level, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
    sale_pairs = f"""WITH {SALES}
SELECT {SALE_COLUMNS} FROM sales WHERE abs(epoch_ms(detail_at) - epoch_ms(order_at)) <= {JOIN_SECONDS} * 1000::BIGINT"""
    return {
        "log_route": f"""WITH {LINES}
SELECT event_id, logDate AS dt, CASE WHEN contains(line, 'startup') THEN 'startup_log' ELSE 'event_log' END AS topic,
       CASE WHEN type = 'startup' THEN 'startup_log' ELSE 'event_log' END AS strict_topic, line AS value FROM lines""",
        "event_parse": f"WITH {LOGS} SELECT event_id, mid, uid, type, evid, itemid, ts, logDate, logHour FROM logs",
        "startup_parse": f"""WITH {LOGS}
SELECT event_id, mid, uid, CAST(NULL AS VARCHAR) AS logType, ts, logDate, logHour FROM logs WHERE type = 'startup'""",
        "cdc_route": f"WITH {ROUTED} SELECT * FROM routed",
        "log_split": f"""WITH {LOGS}
SELECT logDate, count(*) AS n_lines, count(DISTINCT mid) AS devices FROM logs
WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 GROUP BY logDate
UNION ALL SELECT 'bad', count(*), 0 FROM logs WHERE event_id % 7 = 0 OR event_id % 11 = 0""",
        "order_split": f"""WITH {ORDERS}, keyed AS (SELECT *, CAST(id AS BIGINT) AS k FROM o),
split AS (SELECT *, k % 7 = 0 OR k % 11 = 0 OR (k % 17 = 0 AND k % 13 <> 0) AS bad FROM keyed)
SELECT create_date, create_hour, count(*) AS n,
       CAST(sum(CASE WHEN k % 13 = 0 THEN CAST('100000000000000000' AS DECIMAL(38,2)) ELSE total_amount END) AS DOUBLE) AS amount
FROM split WHERE NOT bad GROUP BY create_date, create_hour
UNION ALL SELECT 'bad', NULL, count(*), NULL FROM split WHERE bad""",
        "order_parse": f"""WITH {ORDERS}
SELECT id, user_id, order_status, CAST(total_amount AS DOUBLE) AS total_amount, create_date, create_hour
FROM o WHERE order_status = 'O'""",
        "detail_parse": f"""WITH {DETAILS}
SELECT id, order_id, sku_id, CAST(order_price AS DOUBLE) AS sku_price, sku_num FROM d WHERE l_returnflag = 'N'""",
        "user_parse": f"WITH {USERS} SELECT id, login_name, user_level, birthday, gender FROM users",
        "phone_mask": """SELECT c_custkey, left(c_name, 3) || '********' AS order_mask, left(c_name, 4) || '*******' AS sale_mask
FROM customer""",
        "dau_rows": dau,
        "dau_total": f"WITH {ACTIVE} SELECT logDate, count(*) AS total FROM active GROUP BY logDate",
        "dau_hourly": f"WITH {ACTIVE} SELECT logDate, logHour, count(*) AS n FROM active GROUP BY logDate, logHour",
        "hourly_map": f"""WITH {ACTIVE}, h AS (SELECT logDate, logHour, count(*) AS n FROM active GROUP BY logDate, logHour)
SELECT logDate, '{{' || string_agg('"' || logHour || '":' || n, ',' ORDER BY logHour) || '}}' AS hours FROM h GROUP BY logDate""",
        "new_devices": f"""WITH {LOGS}, f AS (SELECT mid, min(logDate) AS logDate FROM logs GROUP BY mid)
SELECT logDate, count(*) AS total FROM f GROUP BY logDate""",
        "seen_anti": f"""WITH {LOGS}
SELECT event_id, logDate, mid FROM logs a WHERE logHour >= '12' AND NOT EXISTS (
  SELECT 1 FROM logs b WHERE b.logDate = a.logDate AND b.mid = a.mid AND b.logHour < '12')""",
        "hourly_compare": f"WITH {ACTIVE}" + _compare(
            "SELECT logDate AS day, logHour AS hour, count(*) AS v FROM active GROUP BY logDate, logHour", "v"
        ),
        "gmv_daily": f"""WITH {LOGS}
SELECT logDate AS create_date, CAST(sum(value) AS DOUBLE) AS amount FROM ({purchases}) GROUP BY logDate""",
        "gmv_hourly": f"""WITH {LOGS}
SELECT logDate AS create_date, logHour AS create_hour, CAST(sum(value) AS DOUBLE) AS amount FROM ({purchases})
GROUP BY logDate, logHour""",
        "gmv_by_order_date": amount_by_day,
        "amount_compare": f"WITH {LOGS}" + _compare(
            f"SELECT logDate AS day, logHour AS hour, CAST(sum(value) AS DOUBLE) AS v FROM ({purchases}) GROUP BY logDate, logHour", "v"
        ),
        "kpi_list": f"""WITH {ACTIVE}
SELECT logDate AS dt, 'dau' AS id, '{KPI_NAMES["dau"]}' AS name, CAST(count(*) AS DOUBLE) AS value FROM active GROUP BY logDate
UNION ALL
SELECT dt, 'new_mid', '{KPI_NAMES["new_mid"]}', CAST(count(*) AS DOUBLE)
FROM (SELECT mid, min(logDate) AS dt FROM active GROUP BY mid) GROUP BY dt
UNION ALL
SELECT logDate, 'order_amount', '{KPI_NAMES["order_amount"]}', CAST(sum(value) AS DOUBLE) FROM ({purchases}) GROUP BY logDate""",
        "kpi_day": f"""WITH {ACTIVE}
SELECT 'dau' AS id, '{KPI_NAMES["dau"]}' AS name, CAST(count(*) AS DOUBLE) AS value FROM active WHERE logDate = '{CURVE_DAY}'
UNION ALL
SELECT 'new_mid', '{KPI_NAMES["new_mid"]}', CAST(count(*) AS DOUBLE)
FROM (SELECT mid, min(logDate) AS dt FROM active GROUP BY mid) WHERE dt = '{CURVE_DAY}'
UNION ALL
SELECT 'order_amount', '{KPI_NAMES["order_amount"]}', CAST(sum(value) AS DOUBLE) FROM ({purchases}) WHERE logDate = '{CURVE_DAY}'""",
        "day_curves": f"""WITH {ACTIVE},
dau AS (SELECT logDate AS day, logHour AS h, CAST(count(*) AS VARCHAR) AS v FROM active GROUP BY 1, 2),
amounts AS (SELECT logDate AS day, logHour AS h, CAST(CAST(sum(value) AS DOUBLE) AS VARCHAR) AS v FROM ({purchases}) GROUP BY 1, 2)
""" + " UNION ALL ".join(
            f"SELECT '{metric}' AS metric, " + ", ".join(
                f"(SELECT '{{' || string_agg('\"' || h || '\":' || v, ',' ORDER BY h) || '}}' FROM {rows} WHERE day = {day}) AS {name}"
                for day, name in (
                    (f"'{CURVE_DAY}'", "today"), (f"strftime(CAST('{CURVE_DAY}' AS DATE) - 1, '%Y-%m-%d')", "yesterday")
                )
            )
            for metric, rows in (("dau", "dau"), ("order_amount", "amounts"))
        ),
        "orders_by_province": f"""WITH {ORDERS}
SELECT n_name AS province, count(*) AS n_orders, CAST(sum(total_amount) AS DOUBLE) AS amount,
       CAST(least(floor(count(*) / 100) * 100, 500) AS BIGINT) AS bucket
FROM o LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = user_id LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""",
        "sale_full_outer": f"""WITH {ORDERS},{DETAILS}
SELECT coalesce(o.id, d.order_id) AS order_id, d.id AS detail_id,
       CASE WHEN o.id IS NULL THEN 'detail only' WHEN d.id IS NULL THEN 'order only' ELSE 'both' END AS side
FROM o FULL OUTER JOIN d ON o.id = d.order_id""",
        "sale_wide": f"WITH {SALES} SELECT {SALE_COLUMNS} FROM sales",
        "sale_interval_join": f"""WITH {ORDERS},{DETAILS}
SELECT o.id AS order_id, d.id AS detail_id FROM o JOIN d ON o.id = d.order_id
WHERE abs(epoch_ms(detail_at) - epoch_ms(order_at)) <= {JOIN_SECONDS} * 1000::BIGINT""",
        "user_age": f"WITH {USERS} SELECT id, birthday, age FROM users",
        "terms_gender": f"""WITH {SALES}
SELECT user_gender, count(*) AS n FROM sales WHERE user_gender IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 2""",
        "terms_age": f"WITH {SALES} SELECT user_age, count(*) AS n FROM sales GROUP BY 1 ORDER BY n DESC, 1 LIMIT 100",
        "terms_name": f"""WITH {SALES}
SELECT sku_name, count(*) AS n FROM sales WHERE sku_name IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""",
        "gender_ratio": f"""WITH {SALES}
SELECT dt, count(*) AS total, {cut(women)} AS female_ratio, round(100 - {cut(women)}, 1) AS male_ratio FROM sales GROUP BY dt""",
        "age_ratio": f"""WITH {SALES}
SELECT dt, count(*) AS total, {cut(low)} AS under_20_ratio, {cut(mid)} AS from_20_ratio,
       round(100 - {cut(low)} - {cut(mid)}, 1) AS from_30_ratio FROM sales GROUP BY dt""",
        "sale_page": f"""WITH {SALES}
SELECT doc_id, dt, sku_name, sku_price, (SELECT count(*) FROM sales) AS total FROM sales ORDER BY doc_id LIMIT 20 OFFSET 40""",
        "sale_report_summary": f"WITH {SALES}, {hits}" + " UNION ALL ".join(
            f" SELECT count(*) AS total, '{title}' AS title, {pos} AS pos, '{name}' AS name, {value} AS value FROM hits"
            for title, pos, name, value in labels
        ),
        "sale_report_page": f"WITH {SALES}, {day_sales}, {_bm25('sales', 'doc_id', 'sku_name', REPORT_WORD)}" + """
SELECT doc_id, sku_name, user_gender, user_age, score FROM day_sales JOIN scores ON doc_id = id
ORDER BY score DESC, doc_id LIMIT 20""",
        "sale_report_words": f"WITH {SALES}, {day_sales}, {_bm25('sales', 'doc_id', 'sku_name', REPORT_WORDS)}" + f"""
SELECT doc_id, sku_name, score FROM day_sales JOIN scores ON doc_id = id
WHERE list_has_all(string_split(sku_name, ' '), {REPORT_WORDS.split()}) ORDER BY score DESC, doc_id LIMIT 20""",
        "sale_report": f"""WITH {SALES}, {hits}, {_bm25('sales', 'doc_id', 'sku_name', REPORT_WORD)},
page AS (SELECT doc_id, score FROM hits JOIN scores ON doc_id = id ORDER BY score DESC, doc_id LIMIT 20)
SELECT 'day' AS asked, count(*) AS total, coalesce((SELECT string_agg(doc_id, ',' ORDER BY score DESC, doc_id) FROM page), '') AS doc_ids,
       {cut(low)} AS under_20, {cut(women)} AS women FROM hits
UNION ALL SELECT 'blank', 0, '', NULL, NULL""",
        "match_terms": " UNION ALL ".join(
            f"(SELECT '{column}' AS column, {column} AS value, count(*) AS n FROM ({_matching('red plate', 'list_has_any').format(extra=', p_brand, p_type')})"
            f" WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY n DESC, {column} LIMIT 5)" for column in ("p_brand", "p_type")
        ),
        "match_and": _matching("red plate", "list_has_all").format(extra=""),
        "match_or": _matching("red plate", "list_has_any").format(extra=""),
        "match_han": f"""WITH named AS (
  SELECT p_partkey, replace({_han("p_name")}, ' ', '') AS name FROM part)
SELECT p_partkey, name, contains(name, '{HAN_KEYWORD[0]}') AND contains(name, '{HAN_KEYWORD[1]}') AS all_of_them FROM named
WHERE contains(name, '{HAN_KEYWORD[0]}') OR contains(name, '{HAN_KEYWORD[1]}')""",
        "bool_filter": _matching("red plate", "list_has_any").format(extra=", p_type") + " AND p_type = 'ECONOMY'",
        "bm25_rank": f"WITH {_bm25('documents', 'doc_id', 'text', SEARCH)}"
        " SELECT id AS doc_id, score FROM scores ORDER BY score DESC, id LIMIT 20",
        "search_pages": f"""WITH {_bm25('part', 'p_partkey', 'p_name', PAGED)}
SELECT id AS p_partkey, score, CAST(1 + (row_number() OVER (ORDER BY score DESC, id) - 1) // {PAGE_SIZE} AS INTEGER) AS page
FROM scores JOIN bags USING (id) WHERE list_has_all(bag, {PAGED.split()})""",
        "bm25_max": f"WITH {_bm25('documents', 'doc_id', 'text', SEARCH)} SELECT max(score) AS max_score FROM scores",
        "union_index_scan": f"""WITH {USERS}
SELECT 'part' AS index, '_doc' AS type, CAST(p_partkey AS VARCHAR) AS id, 1.0::DOUBLE AS score,
       '{{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_type":"' || p_type || '"}}' AS source FROM part
UNION ALL
SELECT 'user', '_doc', id, 1.0, '{{"id":"' || id || '","login_name":"' || login_name || '","user_level":"' || user_level
       || '","birthday":"' || birthday || '","gender":"' || gender || '"}}' FROM users
UNION ALL
SELECT 'nation', '_doc', CAST(n_nationkey AS VARCHAR), 1.0,
       '{{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}}' FROM nation""",
        "hit_rows": f"WITH {_bm25('part', 'p_partkey', 'p_name', 'red plate')}" + """
SELECT '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","index":"part","type":"_doc","id":"' || p_partkey || '","score":' || score || '}' AS hit,
       CAST(p_partkey AS VARCHAR) AS rank_id
FROM part JOIN scores ON id = p_partkey ORDER BY score DESC, p_partkey LIMIT 10""",
        "union_columns": """SELECT p_partkey AS id, p_name AS name, p_type, CAST(NULL AS VARCHAR) AS c_mktsegment, 'part' AS index FROM part
UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment, 'user' FROM customer""",
        "alert_windows_all": f"WITH {WINDOWS} SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, mid, n_users FROM windows",
        "alert_throttled": alert_rows,
        "alert_member_counts": f"""WITH {WINDOWS}
SELECT strftime(t.ws, '%Y-%m-%d %H:%M:%S') AS window_start, t.mid,
       count(DISTINCT CASE WHEN evid = 'purchase' THEN itemid END) AS n_items, count(*) AS n_events
FROM throttled t JOIN spread s ON s.ws = t.ws AND s.mid = t.mid GROUP BY t.ws, t.mid""",
        "alert_documents": f"WITH {WINDOWS}, {ALERT_EVENTS} {ALERT_LISTS}",
        "alert_headers": f"""WITH {WINDOWS}, {ALERT_EVENTS}
SELECT doc_id, mid, count(DISTINCT CASE WHEN evid = 'purchase' THEN uid END) AS n_users,
       count(DISTINCT CASE WHEN evid = 'purchase' THEN itemid END) AS n_items, count(*) AS n_events,
       epoch_us(ws + INTERVAL 3 DAYS - INTERVAL 1 MICROSECOND) // 1000 AS ts
FROM found GROUP BY doc_id, mid, ws""",
        "alert_store_stream": f"WITH {WINDOWS_OVER}, {ALERT_EVENTS} {ALERT_LISTS}",
        "user_latest": user_latest,
        "folded_stream": user_latest,
        "upsert_last_wins": """SELECT l_orderkey, l_linestatus, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linestatus DESC, l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1""",
        "dau_stream": dau,
        "first_arrival_stream": f"WITH {LOGS} SELECT DISTINCT logDate, mid FROM logs",
        "gmv_stream": amount_by_day,
        "gmv_day_stream": amount_by_day,
        "user_snapshot_stream": f"WITH {USERS} SELECT id, login_name, user_level, birthday, gender FROM users",
        "log_router_stream": f"""WITH {LINES}
SELECT CASE WHEN contains(line, 'startup') THEN 'startup_log' ELSE 'event_log' END AS topic, line AS value FROM lines""",
        "change_router_stream": f"WITH {ROUTED} SELECT * FROM routed",
        "sale_stream": sale_pairs,
        "sale_day_stream": sale_pairs,
        "sale_live_stream": sale_pairs,
        "sale_waiting_stream": sale_pairs,
        "sale_report_kept": f"""WITH {SALES},
paired AS (SELECT * FROM sales WHERE abs(epoch_ms(detail_at) - epoch_ms(order_at)) <= {JOIN_SECONDS} * 1000::BIGINT),
{_bm25('paired', 'doc_id', 'sku_name', REPORT_WORD)}
SELECT doc_id, sku_name, user_gender, user_age, score FROM paired JOIN scores ON doc_id = id
WHERE dt = '{KEPT_DAY}' ORDER BY score DESC, doc_id LIMIT 20""",
        "coverage_stream": f"""WITH {ORDERS},{DETAILS},
ends AS (SELECT least((SELECT max(order_at) FROM o), (SELECT max(detail_at) FROM d)) - INTERVAL 10 SECONDS
                - {JOIN_SECONDS // 86400} * INTERVAL 1 DAY AS passed),
pairs AS (SELECT o.id AS order_id, d.id AS detail_id FROM o JOIN d ON o.id = d.order_id
          WHERE abs(epoch_ms(detail_at) - epoch_ms(order_at)) <= {JOIN_SECONDS} * 1000::BIGINT)
SELECT order_id, detail_id, 'both' AS side FROM pairs
UNION ALL SELECT id, NULL, 'order only' FROM o, ends WHERE order_at < passed AND id NOT IN (SELECT order_id FROM pairs)
UNION ALL SELECT order_id, id, 'detail only' FROM d, ends WHERE detail_at < passed AND id NOT IN (SELECT detail_id FROM pairs)""",
        "raw_log_stream": f"WITH {LINES} SELECT logDate AS dt, line AS value FROM lines",
        "alert_stream": alert_rows,
        "batch_counts": "SELECT count(*) AS n_rows FROM events",
        "late_rows_stream": f"""WITH {LOGS},
sent AS (SELECT *, CASE WHEN event_id % 10 = 0 THEN TIMESTAMP '{DELIVERED}' ELSE event_at END AS sent_at FROM logs),
bounds AS (SELECT floor(epoch(min(sent_at))) AS first, floor(epoch(max(sent_at))) AS last FROM sent),
sliced AS (SELECT *, floor((floor(epoch(sent_at)) - first) * 4 / (last - first + 1)) AS slice FROM sent, bounds),
parts AS (SELECT mid, CASE WHEN date_trunc('hour', event_at) + INTERVAL 1 HOUR + INTERVAL 1 HOUR
                 <= (SELECT max(b.event_at) FROM sliced b WHERE b.slice < a.slice) THEN 'late' ELSE 'kept' END AS part
          FROM sliced a)
SELECT part, mid, count(*) AS n FROM parts GROUP BY part, mid""",
        "recovered_stream": amount_by_day,
        "paced_stream": amount_by_day,
        "posted_lines_stream": f"""WITH {LINES}
SELECT CASE WHEN contains(line, 'startup') THEN 'startup_log' ELSE 'event_log' END AS topic, count(*) AS n FROM lines GROUP BY 1""",
    }
