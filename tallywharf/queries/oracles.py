"""``ORACLES``: name → SQL over the driver's tables that gives the same rows as the query of that name."""

from ..functions import shares
from ..plans import reports

DAY, DAY_BEFORE, EARLY_DAY, ORDER_DAY = "2024-01-15", "2024-01-14", "2024-01-02", "1998-10-03"

_SHOP_TIME = "(date_trunc('second', ts) + INTERVAL 8 HOUR)"

_FIRSTS = """
firsts AS (
  SELECT * FROM (
    SELECT strftime(ts, '%Y-%m-%d') AS log_date, user_id AS mid, CAST(extract(hour FROM ts) AS VARCHAR) AS log_hour,
           event_id, event_type, value,
           row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts, event_id) AS rn
    FROM events)
  WHERE rn = 1)
"""

_DAU_BOTH = f"""
both_days AS (
  SELECT CASE WHEN log_date = '{DAY}' THEN 'today' ELSE 'yesterday' END AS day_label, log_hour AS hour,
         count(*) AS value
  FROM firsts WHERE log_date IN ('{DAY}', '{DAY_BEFORE}') GROUP BY 1, 2)
"""

_PURCHASES = """
purchases AS (
  SELECT strftime(ts, '%Y-%m-%d') AS create_date, CAST(extract(hour FROM ts) AS VARCHAR) AS create_hour,
         value AS total_amount
  FROM events WHERE event_type = 'purchase')
"""

_ORDERS = r"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS order_status,
       o_totalprice AS total_amount, o_orderpriority AS order_comment,
       regexp_replace(c_name, '(\w{3})\w*(\w{4})', '\1****\2', 'g') AS consignee_tel,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time, strftime(o_orderdate, '%Y-%m-%d') AS create_date,
       CAST(extract(hour FROM o_orderdate) AS VARCHAR) AS create_hour
FROM orders JOIN customer ON o_custkey = c_custkey
"""

_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

_JOINED = f"""
joined AS (
  SELECT {_LINE_ID} AS order_detail_id, o_orderkey AS order_id, o_orderstatus AS order_status,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time, o_custkey AS user_id, l_partkey AS sku_id,
         l_extendedprice AS sku_price, p_name AS sku_name, strftime(o_orderdate, '%Y-%m-%d') AS dt
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey)
"""

_SALES = f"""
{_JOINED}, sales AS (
  SELECT joined.*,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'F' WHEN c_mktsegment <> 'FURNITURE' THEN 'M' END AS user_gender,
         CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey + 10 AS INTEGER) ELSE 0 END AS user_age,
         CASE WHEN c_custkey IS NULL THEN NULL WHEN c_acctbal > 5000 THEN 'gold' ELSE 'basic' END AS user_level
  FROM joined LEFT JOIN customer ON user_id = c_custkey)
"""

_HITS = f"""
{_SALES}, hits AS (
  SELECT * FROM (
    SELECT *, CAST(list_contains(words, 'red') AS INTEGER) + CAST(list_contains(words, 'bolt') AS INTEGER) AS score
    FROM (SELECT *, string_split_regex(lower(sku_name), '\\W+') AS words FROM sales))
  WHERE score > 0)
"""


def _shares(hits):
    return f"""
ages AS (
  SELECT count(*) FILTER (user_age < 20) AS young, count(*) FILTER (user_age >= 30) AS old, count(*) AS known
  FROM {hits} WHERE user_age IS NOT NULL),
genders AS (
  SELECT count(*) FILTER (user_gender <> 'F') AS male, count(*) AS known FROM {hits} WHERE user_gender IS NOT NULL),
age_rows AS (
  SELECT young_share, old_share, round_even(100.0 - young_share - old_share, 2) AS middle_share
  FROM (SELECT round_even(young * 100.0::DOUBLE / nullif(known, 0), 2) AS young_share,
               round_even(old * 100.0::DOUBLE / nullif(known, 0), 2) AS old_share FROM ages)),
gender_rows AS (
  SELECT round_even(male * 100.0::DOUBLE / nullif(known, 0), 2) AS male_share,
         round_even(100.0 - male * 100.0::DOUBLE / nullif(known, 0), 2) AS female_share
  FROM genders)
"""


def _report(hits_filter):
    def option(name, value):
        return f"""'{{"name":"{name}"' || coalesce(',"value":' || {value}, '') || '}}'"""

    def stat(title, *options):
        return f"""'{{"title":"{title}","options":[' || {" || ',' || ".join(options)} || ']}}'"""

    age = stat(shares.AGE_TITLE, option(shares.UNDER_20, "young_share"),
               option(shares.FROM_20_TO_29, "middle_share"), option(shares.FROM_30, "old_share"))
    gender = stat(shares.GENDER_TITLE, option(shares.MALE, "male_share"), option(shares.FEMALE, "female_share"))
    return f"""
WITH {_HITS}, found AS (SELECT * FROM hits WHERE {hits_filter}), {_shares("found")}
SELECT (SELECT count(*) FROM found) AS total,
       (SELECT coalesce(string_agg(order_detail_id, ',' ORDER BY score DESC, order_detail_id), '') FROM (
          SELECT * FROM found ORDER BY score DESC, order_detail_id LIMIT 5)) AS detail,
       '[' || {age} || ',' || {gender} || ']' AS stat
FROM age_rows, gender_rows
"""


def _alerts(windows, where="TRUE"):
    """Alerts of ``windows``, a relation of (mid, uid, evid, itemid, window_end as UTC time)."""
    return f"""
WITH logs AS (
  SELECT CAST(user_id // 10 AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid, event_type AS evid, props AS itemid,
         CAST(floor(epoch(ts)) AS BIGINT) AS s
  FROM events),
placed AS ({windows}),
accounts AS (
  SELECT mid, uid, e FROM placed GROUP BY 1, 2, 3
  HAVING bool_or(evid = 'view') AND NOT bool_or(evid = 'error')),
alerting AS (SELECT mid, e FROM accounts GROUP BY 1, 2 HAVING count(*) > 3),
devices AS (SELECT mid, max(e) AS e FROM alerting GROUP BY mid, e // 60),
guilty AS (
  SELECT placed.* FROM placed
  JOIN accounts ON placed.mid = accounts.mid AND placed.uid = accounts.uid AND placed.e = accounts.e
  JOIN devices ON placed.mid = devices.mid AND placed.e = devices.e),
kept AS (SELECT * FROM guilty WHERE {where}),
entries AS (
  SELECT mid, e, 'account' AS kind, uid AS value FROM kept
  UNION ALL SELECT mid, e, 'item', itemid FROM kept
  UNION ALL SELECT mid, e, 'event', evid FROM kept)
SELECT mid || ' ' || strftime(make_timestamp((e + 28800) * 1000000), '%Y-%m-%d %H:%M') AS doc_id, mid,
       strftime(make_timestamp((e + 28800) * 1000000), '%Y-%m-%d %H:%M') AS minute, kind, value, count(*) AS n,
       CAST(e * 1000 AS BIGINT) AS ts
FROM entries WHERE value IS NOT NULL GROUP BY mid, e, kind, value
"""


_DAILY = "SELECT *, ((s + 28800) // 86400 + 1) * 86400 - 28800 AS e FROM logs"


def _sliding(window, slide):
    return f"""
SELECT *, (s // {slide}) * {slide} - k * {slide} + {window} AS e
FROM logs, generate_series(0, {window // slide - 1}) AS g(k)
"""


# One second of the thinned clock is an hour of the table.
_HOURLY = """
SELECT mid, uid, evid, itemid, (h // 10) * 10 - k * 10 + 20 AS e
FROM (SELECT *, s // 3600 AS h FROM logs), generate_series(0, 1) AS g(k)
"""


_NAMES = dict(reports.KPI_NAMES)

ORACLES = {
    "startup_typed": f"""
SELECT 'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS uid, 'shop' AS appid, CAST(NULL AS VARCHAR) AS area,
       event_type AS ch, 'startup' AS type, CAST(event_id AS VARCHAR) AS vs,
       CAST(floor(epoch(ts)) AS BIGINT) AS ts, strftime({_SHOP_TIME}, '%Y-%m-%d') AS log_date,
       CAST(extract(hour FROM {_SHOP_TIME}) AS VARCHAR) AS log_hour
FROM events
""",
    "event_typed": f"""
SELECT 'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS uid, 'event' AS type, event_type AS evid,
       CAST(event_id AS VARCHAR) AS pgid, regexp_extract(props, '[0-9]+') AS itemid,
       CAST(floor(epoch(ts)) AS BIGINT) AS ts, strftime({_SHOP_TIME}, '%Y-%m-%d') AS log_date,
       CAST(extract(hour FROM {_SHOP_TIME}) AS VARCHAR) AS log_hour
FROM events
""",
    "order_typed_masked": _ORDERS,
    "age_years": """
SELECT o_orderkey, CAST((epoch_ms(TIMESTAMP '2024-01-01') - epoch_ms(o_orderdate)) // 31536000000 AS INTEGER) AS age
FROM orders
""",
    "dau_first_event": f"WITH {_FIRSTS} SELECT log_date, mid, log_hour, event_id, event_type, value FROM firsts",
    "dau_total": f"WITH {_FIRSTS} SELECT count(*) AS dau FROM firsts WHERE log_date = '{DAY}'",
    "dau_by_hour": f"""
WITH {_FIRSTS} SELECT log_hour AS hour, count(*) AS nums FROM firsts WHERE log_date = '{DAY}' GROUP BY 1
""",
    "new_mid_count": f"""
SELECT count(*) AS new_mid
FROM (SELECT user_id, min(CAST(ts AS DATE)) AS first_day FROM events GROUP BY user_id)
WHERE first_day = DATE '{EARLY_DAY}'
""",
    "dau_hours_compare": f"WITH {_FIRSTS}, {_DAU_BOTH} SELECT day_label, hour, value FROM both_days",
    "hours_map": f"""
WITH {_FIRSTS}, {_DAU_BOTH},
texts AS (
  SELECT day_label, '{{' || string_agg('"' || hour || '":' || value, ',' ORDER BY CAST(hour AS INTEGER)) || '}}' AS m
  FROM both_days GROUP BY 1)
SELECT coalesce(max(m) FILTER (day_label = 'today'), '{{}}') AS today,
       coalesce(max(m) FILTER (day_label = 'yesterday'), '{{}}') AS yesterday
FROM texts
""",
    "gmv_total": f"SELECT round(sum(o_totalprice), 2) AS gmv FROM orders WHERE CAST(o_orderdate AS DATE) = '{ORDER_DAY}'",
    "gmv_by_hour": f"""
WITH {_PURCHASES}
SELECT create_hour AS hour, round(sum(total_amount), 2) AS gmv FROM purchases WHERE create_date = '{DAY}' GROUP BY 1
""",
    "gmv_hours_compare": f"""
WITH {_PURCHASES}
SELECT CASE WHEN create_date = '{DAY}' THEN 'today' ELSE 'yesterday' END AS day_label, create_hour AS hour,
       round(sum(total_amount), 2) AS value
FROM purchases WHERE create_date IN ('{DAY}', '{DAY_BEFORE}') GROUP BY 1, 2
""",
    "kpi_totals": f"""
WITH {_FIRSTS}, {_PURCHASES}
SELECT 'dau' AS id, '{_NAMES["dau"]}' AS name, CAST(count(*) AS DOUBLE) AS value FROM firsts WHERE log_date = '{DAY}'
UNION ALL
SELECT 'new_mid', '{_NAMES["new_mid"]}', CAST(count(*) AS DOUBLE) FROM firsts t
WHERE log_date = '{DAY}' AND NOT EXISTS (SELECT 1 FROM firsts h WHERE h.mid = t.mid AND h.log_date < '{DAY}')
UNION ALL
SELECT 'order_amount', '{_NAMES["order_amount"]}', round(sum(total_amount), 2) FROM purchases
WHERE create_date = '{DAY}'
""",
    "user_latest": """
SELECT user_id, event_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""",
    "keyed_upsert": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
             l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem)
WHERE rn = 1
""",
    "sale_detail_join": f"WITH {_JOINED} SELECT * FROM joined",
    "sale_detail_join_timed": f"""
SELECT {_LINE_ID} AS order_detail_id, o_orderkey AS order_id, o_orderstatus AS order_status, o_custkey AS user_id,
       CAST(l_partkey AS VARCHAR) AS sku_id, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS sku_price,
       strftime(o_orderdate, '%Y-%m-%d') AS dt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey % 6 < 4
""",
    "sale_detail_enriched": f"WITH {_SALES} SELECT * FROM sales",
    "sale_search_total": f"WITH {_HITS} SELECT count(*) AS total FROM hits",
    "sale_search_page": f"""
WITH {_HITS}
SELECT order_detail_id AS es_metadata_id, score, order_id, sku_id, sku_name FROM hits
ORDER BY score DESC, order_detail_id LIMIT 20 OFFSET 40
""",
    "sale_search_deep_page": f"""
WITH {_HITS}
SELECT order_detail_id AS es_metadata_id, score, order_id, sku_id, sku_name FROM hits
ORDER BY score DESC, order_detail_id LIMIT 20 OFFSET 11000
""",
    "sale_age_share": f"""
WITH {_HITS}, {_shares("hits")}
SELECT '{shares.UNDER_20}' AS name, young_share AS value FROM age_rows
UNION ALL SELECT '{shares.FROM_20_TO_29}', middle_share FROM age_rows
UNION ALL SELECT '{shares.FROM_30}', old_share FROM age_rows
""",
    "sale_gender_share": f"""
WITH {_HITS}, {_shares("hits")}
SELECT '{shares.MALE}' AS name, male_share AS value FROM gender_rows
UNION ALL SELECT '{shares.FEMALE}', female_share FROM gender_rows
""",
    "sale_gender_terms": f"""
WITH {_HITS} SELECT user_gender AS term, count(*) AS n FROM hits WHERE user_gender IS NOT NULL GROUP BY 1
ORDER BY n DESC, term LIMIT 1
""",
    "sale_age_terms": f"""
WITH {_HITS} SELECT user_age AS term, count(*) AS n FROM hits WHERE user_age IS NOT NULL GROUP BY 1
ORDER BY n DESC, term LIMIT 7
""",
    "sale_search_report": _report("TRUE"),
    "sale_search_day_report": _report(f"dt = '{ORDER_DAY}'"),
    "coupon_alert": _alerts(_DAILY),
    "coupon_alert_sliding": _alerts(_sliding(86400, 21600)),
    "coupon_alert_fine_slide": _alerts(_sliding(54000, 1800)),
    "coupon_alert_minute": _alerts(_HOURLY),
    "log_route": """
SELECT CASE WHEN event_type IN ('purchase', 'signup') THEN 'startup' ELSE 'event' END AS topic,
       '{' || CASE event_type WHEN 'purchase' THEN '' WHEN 'signup' THEN '"type":"startup",' ELSE '"type":"event",' END
       || '"uid":"' || user_id || '","seq":' || event_id || ',"evid":"' || event_type || '","ts":'
       || CAST(floor(epoch(ts)) + 5 AS BIGINT) || '}' AS value
FROM events
""",
    "cdc_route": f"""
SELECT 'order_info' AS topic,
       '{{"id":"' || o_orderkey || '","user_id":"' || o_custkey || '","total_amount":"'
       || CAST(o_totalprice AS DECIMAL(18,2)) || '","create_time":"'
       || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"}}' AS value
FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT 'order_detail',
       '{{"id":"' || {_LINE_ID} || '","order_id":"' || l_orderkey || '","sku_id":"' || l_partkey
       || '","order_price":"' || CAST(l_extendedprice AS DECIMAL(18,2)) || '"}}'
FROM lineitem WHERE l_returnflag = 'N'
UNION ALL
SELECT 'user_info',
       '{{"id":"' || c_custkey || '","login_name":"' || c_name || '","gender":"' || c_mktsegment || '"}}'
FROM customer WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE')
""",
}

ORACLES["sale_search_range_page"] = ORACLES["sale_search_deep_page"]
ORACLES["sale_search_postings"] = ORACLES["sale_search_day_report"]
ORACLES["log_route_repeated_keys"] = ORACLES["log_route"]
ORACLES["kpi_stored"] = ORACLES["kpi_totals"]
ORACLES["dau_hours_stored"] = ORACLES["dau_hours_compare"]
ORACLES["sale_search_stored_day"] = ORACLES["sale_search_day_report"]
ORACLES["stream_dau"] = ORACLES["dau_first_event"]
ORACLES["stream_orders"] = ORACLES["order_typed_masked"]
ORACLES["stream_user_latest"] = """
SELECT CAST(user_id AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
"""
# Repeated line ids overwrite one document; the last in column order stays.
ORACLES["stream_sale_join"] = f"""
WITH {_SALES} SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_detail_id ORDER BY sku_price DESC) AS rn FROM sales)
WHERE rn = 1
"""
# A stream shows a window only when the latest event is a minute past its end.
ORACLES["stream_alert"] = _alerts(_DAILY, "e + 60 <= (SELECT max(s) FROM logs)")
# Panes close a minute after their end; windows are formed up to the last closed pane that holds events.
ORACLES["stream_alert_sliding"] = _alerts(_sliding(54000, 1800), """e <= (
  SELECT max(s // 1800 * 1800 + 1800) FROM logs WHERE s // 1800 * 1800 + 1860 <= (SELECT max(s) FROM logs))""")
ORACLES["stream_alert_repeated_files"] = ORACLES["stream_alert_sliding"]
ORACLES["stream_alert_minute"] = _alerts(_HOURLY, """e < (
  SELECT (max(s // 3600 // 10 * 10 + 10) + 10) // 60 * 60 FROM logs
  WHERE s // 3600 // 10 * 10 + 70 <= (SELECT max(s // 3600) FROM logs))""")
ORACLES["stream_user_versions"] = """
SELECT CAST(user_id AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1
"""
ORACLES["stream_orders_corrected"] = ORACLES["order_typed_masked"]
ORACLES["gmv_stored"] = ORACLES["gmv_total"]
ORACLES["new_mid_stored"] = ORACLES["new_mid_count"]
ORACLES["stream_sale_join_late"] = f"""
WITH {_SALES} SELECT order_detail_id, CAST(order_id AS VARCHAR) AS order_id, order_status, CAST(user_id AS VARCHAR) AS user_id,
  CAST(sku_id AS VARCHAR) AS sku_id, CAST(CAST(sku_price AS DECIMAL(18,2)) AS DOUBLE) AS sku_price, dt, user_gender, user_age, user_level
FROM (
  SELECT *, row_number() OVER (PARTITION BY order_detail_id ORDER BY sku_price DESC) AS rn FROM sales WHERE sku_id % 6 < 4)
WHERE rn = 1
"""
