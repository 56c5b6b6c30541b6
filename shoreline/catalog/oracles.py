"""DuckDB twins of the published queries, written from the definitions, not from the plans.

The common table expressions derive the same source rows as ``frames.py``.
"""

from __future__ import annotations

from shoreline.catalog.frames import AUDIT_TIME, BATCH_TIME, DATE, OFF_TIE

STAMP = "'%Y-%m-%d %H:%M:%S.%f'"
DAY = "'%Y-%m-%d'"

SOURCES = f"""
ev AS (
  SELECT * REPLACE (value + {OFF_TIE} AS value),
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
deliveries AS (
  SELECT event_id, ts, user_id, event_type, k, value,
         ts + INTERVAL 1 MINUTE AS _ingested_at, event_id * 2 AS _kafka_offset FROM ev
  UNION ALL
  SELECT event_id, ts, user_id, event_type, k, value + 1,
         ts + to_minutes(CAST(k - 50 AS BIGINT)), event_id * 2 + 1 FROM ev
),
user_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN k <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
         's' || user_id AS session_id, event_type, '/' || event_type AS page_url,
         CASE WHEN k >= 30 THEN '/home' END AS referrer,
         CASE WHEN k < 50 THEN 'mobile' ELSE 'desktop' END AS device,
         'firefox' AS browser, 'VN' AS country,
         CASE WHEN k <> 1 THEN ts END AS timestamp, 'user_events' AS _source,
         _kafka_offset, _ingested_at
  FROM deliveries WHERE event_type <> 'error'
),
clickstream AS (
  SELECT CASE WHEN k <> 2 THEN 'r' || event_id END AS request_id, 'GET' AS method,
         CASE WHEN k <> 3 THEN '/' || event_type END AS path,
         k + 200 AS status_code, CAST(floor(value * 10) AS INTEGER) AS latency_ms,
         CAST(floor(value * 100) AS BIGINT) AS bytes_sent, 'agent' AS user_agent,
         '10.0.0.' || k AS ip_address, ts AS timestamp, 'clickstream' AS _source,
         _kafka_offset, _ingested_at
  FROM deliveries WHERE event_type = 'error'
),
txns AS (
  SELECT 't' || event_id AS txn_id, CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN k < 14 THEN 'refund' ELSE 'purchase' END AS txn_type,
         CASE WHEN k = 99 THEN NULL WHEN k < 14 THEN -value ELSE value END AS amount,
         CASE WHEN k < 50 THEN 'USD' WHEN k < 80 THEN 'EUR' ELSE 'VND' END AS currency,
         CASE WHEN k < 5 THEN NULL WHEN k < 40 THEN 'card' WHEN k < 70 THEN 'wallet'
              ELSE 'transfer' END AS payment_method,
         CASE WHEN k < 60 THEN 'completed' WHEN k < 80 THEN 'pending' ELSE 'failed' END AS status,
         'm' || k AS merchant_id, ts AS timestamp, 'transactions' AS _source,
         _kafka_offset, _ingested_at
  FROM deliveries WHERE event_type <> 'signup'
),
pays AS (
  SELECT 'p' || event_id AS payment_id, 'o' || event_id AS order_id,
         'c' || user_id AS customer_id, value AS amount,
         CASE WHEN k < 50 THEN 'USD' WHEN k < 80 THEN 'EUR' ELSE 'VND' END AS currency,
         CASE WHEN k < 5 THEN NULL WHEN k < 40 THEN 'card' WHEN k < 70 THEN 'wallet'
              ELSE 'transfer' END AS payment_method,
         CASE WHEN k < 70 THEN 'success' WHEN k < 80 THEN 'pending' WHEN k < 90 THEN 'failed'
              ELSE 'refunded' END AS payment_status,
         'gate' AS gateway, value * 0.02 AS transaction_fee,
         CASE WHEN k = 98 THEN 'not a date' ELSE strftime(ts, {DAY}) END AS payment_date,
         'payments' AS _source, 'drop-' || _kafka_offset AS _file_path, _ingested_at
  FROM deliveries WHERE event_type = 'signup'
),
iot AS (
  SELECT CAST(event_id AS VARCHAR) AS reading_id, event_type AS sensor_type,
         CASE WHEN k <> 4 THEN value END AS value,
         'loc_' || CAST(floor(k / 25.0) AS INTEGER) AS location, ts AS timestamp
  FROM ev
),
crm_once AS (
  SELECT 'c' || c_custkey AS customer_id, c_name AS first_name,
         CASE WHEN c_acctbal >= 0 THEN c_name || '@example.com' END AS email,
         c_mktsegment AS segment, c_acctbal AS lifetime_value, c_nationkey AS shift FROM customer
  UNION ALL
  SELECT 's' || s_suppkey, s_name, s_name || '@example.com', 'SUPPLIER', s_acctbal, s_nationkey
  FROM supplier
),
crm AS (
  SELECT customer_id, first_name, email, segment, lifetime_value, 'drop-1' AS _file_path,
         TIMESTAMP '{BATCH_TIME}' AS _ingested_at FROM crm_once
  UNION ALL
  SELECT customer_id, first_name, email, segment, lifetime_value + 1, 'drop-2',
         TIMESTAMP '{BATCH_TIME}' + to_minutes(CAST(shift - 12 AS BIGINT)) FROM crm_once
),
cust_orders AS (
  SELECT 'o' || o_orderkey AS order_id, 'c' || o_custkey AS customer_id,
         o_totalprice AS total_amount, o_orderstatus AS status,
         strftime(o_orderdate, {DAY}) AS order_date FROM orders
),
stock_once AS (
  SELECT 'p' || p_partkey AS sku, p_name AS product_name, p_type AS category,
         'WH-' || p_brand AS warehouse,
         CAST(round((p_retailprice - 900) * 10) AS INTEGER) AS quantity_on_hand,
         p_size + 10 AS reorder_point, p_retailprice + {OFF_TIE} AS unit_cost, p_size AS shift FROM part
  UNION ALL
  SELECT 's' || s_suppkey, s_name, 'SERVICE', 'WH-none', 0, NULL, s_acctbal, s_nationkey
  FROM supplier
),
stock AS (
  SELECT sku, product_name, category, warehouse, quantity_on_hand, reorder_point, unit_cost,
         'drop-1' AS _file_path, TIMESTAMP '{BATCH_TIME}' AS _ingested_at FROM stock_once
  UNION ALL
  SELECT sku, product_name, category, warehouse, quantity_on_hand, reorder_point, unit_cost + 1,
         'drop-2', TIMESTAMP '{BATCH_TIME}' + to_minutes(CAST(shift - 20 AS BIGINT))
  FROM stock_once
),
prod_orders AS (
  SELECT 'o' || l_orderkey || '-' || l_linenumber AS order_id, 'p' || l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         l_extendedprice * (1 - l_discount) AS total_amount FROM lineitem
),
by_cust AS (
  SELECT customer_id, count(order_id) AS n, sum(total_amount) AS total,
         max(order_date) AS latest, avg(total_amount) AS mean
  FROM cust_orders GROUP BY customer_id
),
by_prod AS (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units, count(order_id) AS n,
         sum(total_amount) AS total FROM prod_orders GROUP BY product_id
)
"""

DOMAINS = f"""
all_events AS (
  SELECT event_id, 'user_events' AS event_source, timestamp, user_id, session_id, event_type,
         page_url, referrer, device, browser, country,
         CAST(NULL AS VARCHAR) AS request_id, CAST(NULL AS VARCHAR) AS method,
         CAST(NULL AS VARCHAR) AS path, CAST(NULL AS INTEGER) AS status_code,
         CAST(NULL AS INTEGER) AS latency_ms, CAST(NULL AS BIGINT) AS bytes_sent,
         CAST(NULL AS VARCHAR) AS user_agent, CAST(NULL AS VARCHAR) AS ip_address,
         _ingested_at, _kafka_offset
  FROM user_events
  UNION ALL
  SELECT request_id, 'clickstream', timestamp, NULL, NULL, NULL, path, NULL, NULL, NULL, NULL,
         request_id, method, path, status_code, latency_ms, bytes_sent, user_agent, ip_address,
         _ingested_at, _kafka_offset
  FROM clickstream
),
ev_silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
                                 ORDER BY _ingested_at DESC, _kafka_offset DESC) AS rn
    FROM all_events) WHERE rn = 1 AND event_id IS NOT NULL AND timestamp IS NOT NULL
),
all_txns AS (
  SELECT txn_id AS transaction_id, 'transactions' AS transaction_source, timestamp, user_id,
         txn_type, merchant_id, status, CAST(NULL AS VARCHAR) AS order_id,
         CAST(NULL AS VARCHAR) AS customer_id, CAST(NULL AS VARCHAR) AS payment_status,
         CAST(NULL AS VARCHAR) AS gateway, CAST(NULL AS DOUBLE) AS transaction_fee, amount,
         currency, payment_method, _ingested_at,
         CAST(_kafka_offset AS VARCHAR) AS tie, _kafka_offset AS offset_tie
  FROM txns
  UNION ALL
  SELECT payment_id, 'payments', TRY_CAST(payment_date AS TIMESTAMP), NULL, NULL, NULL, NULL,
         order_id, customer_id, payment_status, gateway, transaction_fee, amount, currency,
         payment_method, _ingested_at, _file_path, NULL
  FROM pays
),
tx_silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _ingested_at DESC,
                                 offset_tie DESC NULLS LAST, tie DESC) AS rn
    FROM all_txns) WHERE rn = 1 AND timestamp IS NOT NULL AND amount IS NOT NULL
),
crm_latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id
                                 ORDER BY _ingested_at DESC, _file_path DESC) AS rn
    FROM crm) WHERE rn = 1
),
stock_latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY sku
                                 ORDER BY _ingested_at DESC, _file_path DESC) AS rn
    FROM stock) WHERE rn = 1
),
stock_silver AS (
  SELECT s.*, coalesce(p.units, 0) AS total_quantity_sold, coalesce(p.n, 0) AS total_orders,
         coalesce(p.total, 0.0) AS total_sales_value,
         CASE WHEN quantity_on_hand <= reorder_point THEN 'low_stock'
              WHEN quantity_on_hand <= 0 THEN 'out_of_stock' ELSE 'in_stock' END AS stock_status
  FROM stock_latest s LEFT JOIN by_prod p ON s.sku = p.product_id
)
"""

# In the wide form each source is deduplicated on its own, and a missing request id
# is not tested, so the latest of those rows stays.
WIDE = """
ue_wide AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
                                 ORDER BY _ingested_at DESC, _kafka_offset DESC) AS rn
    FROM user_events)
  WHERE rn = 1 AND event_id IS NOT NULL AND user_id IS NOT NULL AND timestamp IS NOT NULL
),
cs_wide AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id
                                 ORDER BY _ingested_at DESC, _kafka_offset DESC) AS rn
    FROM clickstream)
  WHERE rn = 1 AND path IS NOT NULL AND timestamp IS NOT NULL
),
ev_wide AS (
  SELECT event_id, user_id, session_id, event_type, page_url, CAST(NULL AS VARCHAR) AS path,
         CAST(NULL AS VARCHAR) AS method, CAST(NULL AS INTEGER) AS status_code,
         CAST(NULL AS INTEGER) AS latency_ms, device, browser,
         CAST(NULL AS VARCHAR) AS user_agent, CAST(NULL AS VARCHAR) AS ip_address, country,
         timestamp, _source, _ingested_at FROM ue_wide
  UNION ALL
  SELECT request_id, NULL, NULL, NULL, NULL, path, method, status_code, latency_ms, NULL, NULL,
         user_agent, ip_address, NULL, timestamp, _source, _ingested_at FROM cs_wide
),
tx_wide AS (
  SELECT txn_id, CAST(NULL AS VARCHAR) AS order_id, user_id, CAST(NULL AS VARCHAR) AS customer_id,
         txn_type, amount, currency, payment_method, CAST(NULL AS VARCHAR) AS payment_status,
         status, CAST(NULL AS VARCHAR) AS gateway, merchant_id,
         CAST(NULL AS DOUBLE) AS transaction_fee, timestamp,
         CAST(NULL AS VARCHAR) AS payment_date, _source, _ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY txn_id
                                     ORDER BY _ingested_at DESC, _kafka_offset DESC) AS rn
        FROM txns) WHERE rn = 1 AND amount IS NOT NULL
  UNION ALL
  SELECT payment_id, order_id, NULL, customer_id, NULL, amount, currency, payment_method,
         payment_status, NULL, gateway, NULL, transaction_fee, NULL, payment_date, _source,
         _ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY payment_id
                                     ORDER BY _ingested_at DESC, _file_path DESC) AS rn
        FROM pays) WHERE rn = 1 AND amount IS NOT NULL
),
stock_wide AS (
  SELECT s.*, p.n AS orders_count, p.units AS units_sold
  FROM stock_latest s LEFT JOIN by_prod p ON s.sku = p.product_id
  WHERE quantity_on_hand IS NOT NULL
),
cohorts AS (
  SELECT user_id, CAST(min(timestamp) AS DATE) AS cohort,
         datediff('day', min(timestamp), max(timestamp)) AS days, count(event_id) AS n
  FROM ev_wide GROUP BY user_id
)
"""

SENSORS = """
base AS (
  SELECT sensor_type, avg(value) AS m, stddev_samp(value) AS sd FROM iot GROUP BY sensor_type
),
scored AS (
  SELECT i.*, m, sd, (value - m) / nullif(sd, 0) AS z, m - 3 * sd AS lo, m + 3 * sd AS hi
  FROM iot i JOIN base USING (sensor_type)
)
"""

REVENUE = """
per_day AS (
  SELECT CAST(timestamp AS DATE) AS d, sum(amount) AS total_revenue, count(*) AS n,
         avg(amount) AS mean, count(DISTINCT coalesce(customer_id, user_id)) AS people,
         sum(transaction_fee) AS fees FROM tx_silver GROUP BY 1
),
act AS (
  SELECT CAST(timestamp AS DATE) AS d, count(event_id) AS n, count(DISTINCT user_id) AS users
  FROM ev_silver GROUP BY 1
)
"""

COHORT_GRID = """
daily AS (SELECT DISTINCT user_id, CAST(timestamp AS DATE) AS d FROM {table}
          WHERE user_id IS NOT NULL),
starts AS (SELECT user_id, min(d) AS c FROM daily GROUP BY 1),
hits AS (SELECT s.c, datediff('day', s.c, CAST(e.timestamp AS DATE)) AS age, e.user_id, e.event_id
         FROM {table} e JOIN starts s ON e.user_id = s.user_id),
grid AS (SELECT c, age, count(DISTINCT user_id) AS users, count(event_id) AS n
         FROM hits GROUP BY 1, 2),
sizes AS (SELECT c, users AS size FROM grid WHERE age = 0)
"""

TURNOVER = """
cat AS (
  SELECT category, count(sku) AS products, sum(quantity_on_hand) AS units,
         sum(total_quantity_sold) AS sold, sum(total_sales_value) AS revenue,
         avg(CASE WHEN quantity_on_hand > 0
                  THEN CAST(total_quantity_sold AS DOUBLE) / quantity_on_hand ELSE 0 END) AS turn,
         sum(quantity_on_hand * unit_cost) AS worth,
         count(*) FILTER (WHERE quantity_on_hand <= reorder_point) AS low,
         count(*) FILTER (WHERE stock_status = 'out_of_stock') AS gone
  FROM stock_silver GROUP BY category
)
"""

WAREHOUSE = """
wh AS (
  SELECT category, warehouse, count(sku) AS skus, sum(quantity_on_hand) AS units,
         sum(quantity_on_hand * unit_cost) AS worth, avg(unit_cost) AS cost,
         sum(units_sold) AS sold, sum(orders_count) AS n,
         count(*) FILTER (WHERE quantity_on_hand <= reorder_point) AS low
  FROM stock_wide GROUP BY 1, 2
),
cogs AS (SELECT coalesce(sum(amount), 0.0) AS total FROM tx_wide WHERE txn_type = 'purchase'),
share AS (SELECT wh.*, (SELECT total FROM cogs) / (SELECT count(*) FROM wh) AS cogs FROM wh)
"""

_LINES = """
payloads AS (
  SELECT event_id, event_type, user_id, round(value, 2) AS value, ts,
         CASE event_type WHEN 'purchase' THEN
           to_json({{'event_id': CAST(event_id AS VARCHAR), 'user_id': user_id,
                     'event_type': event_type, 'value': round(value, 2),
                     'timestamp': strftime(ts, '{time}'), '_source': 'payload'}})
         ELSE
           to_json({{'event_id': CAST(event_id AS VARCHAR), 'user_id': user_id,
                     'event_type': event_type, 'value': round(value, 2),
                     'timestamp': strftime(ts, '{time}')}}) END AS body FROM ev
),
lines AS (
  SELECT event_id, event_type, user_id, value, ts, CAST(body AS VARCHAR) AS body,
         CASE event_type WHEN 'error' THEN left(CAST(body AS VARCHAR), length(CAST(body AS VARCHAR)) - 1)
                         WHEN 'view' THEN '[' || CAST(body AS VARCHAR) || ']'
                         ELSE CAST(body AS VARCHAR) END AS line,
         CASE event_type WHEN 'purchase' THEN 'events.txn' WHEN 'signup' THEN 'no.route'
                         ELSE 'events.user' END AS topic FROM payloads
),
routed AS (
  SELECT *, CASE topic WHEN 'events.txn' THEN 'transactions' WHEN 'events.user' THEN 'user_events'
                       ELSE 'unknown' END AS source,
         CASE WHEN NOT json_valid(line) THEN 'malformed_json'
              WHEN json_type(line) <> 'OBJECT' THEN 'not_an_object' ELSE 'ok' END AS outcome
  FROM lines
)
"""

LINES = _LINES.format(time="%Y-%m-%dT%H:%M:%S.%fZ")
DAY_LINES = _LINES.format(time="%Y-%m-%d")


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


BASE = _with(SOURCES)
DOM = _with(SOURCES, DOMAINS)
WID = _with(SOURCES, DOMAINS, WIDE)

ORACLES: dict[str, str] = {}

# --- row operators -------------------------------------------------------------------

ORACLES["dedup_latest"] = f"""{BASE}
SELECT event_id, user_id, event_type, round(value, 4) AS value, _kafka_offset FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id
                               ORDER BY _ingested_at DESC, _kafka_offset DESC) AS rn
  FROM deliveries) WHERE rn = 1"""

ORACLES["mandatory_filter"] = f"""{BASE}
SELECT event_id, user_id, strftime(timestamp, {STAMP}) AS timestamp, _kafka_offset
FROM user_events WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND timestamp IS NOT NULL"""

ORACLES["successful_transactions"] = f"""{DOM}
SELECT transaction_id, transaction_source, round(amount, 4) AS amount FROM all_txns
WHERE status = 'completed' OR payment_status = 'success'"""

ORACLES["purchase_transactions"] = f"""{BASE}
SELECT txn_id, round(amount, 4) AS amount, _kafka_offset FROM txns WHERE txn_type = 'purchase'"""

ORACLES["sensor_source_filter"] = f"""{BASE}
SELECT request_id AS reading_id, 'latency' AS sensor_type, CAST(latency_ms AS DOUBLE) AS value,
       strftime(timestamp, {STAMP}) AS timestamp
FROM clickstream WHERE status_code >= 250 AND latency_ms IS NOT NULL"""

# --- shape ----------------------------------------------------------------------------

ORACLES["union_missing_columns"] = f"""{BASE}
SELECT _source, event_id, NULL AS request_id, event_type, NULL AS method,
       CAST(NULL AS INTEGER) AS status_code, _kafka_offset FROM user_events
UNION ALL
SELECT _source, NULL, request_id, NULL, method, status_code, _kafka_offset FROM clickstream"""

ORACLES["conform_to_schema"] = f"""{BASE}
SELECT event_id, CASE WHEN k < 50 THEN k END AS status_code, round(value, 4) AS latency_ms,
       CAST(NULL AS VARCHAR) AS country, strftime(ts, {DAY}) AS dt FROM ev"""

ORACLES["event_time_bucket"] = f"""{BASE}
SELECT _source AS source, strftime(coalesce(timestamp, _ingested_at), {DAY}) AS dt,
       strftime(coalesce(timestamp, _ingested_at), '%H') AS hour, count(*) AS row_count
FROM user_events GROUP BY 1, 2, 3"""

ORACLES["line_totals"] = """
SELECT l_returnflag, l_linestatus, round(min(t), 2) AS smallest, round(max(t), 2) AS largest,
       count(t) AS line_count
FROM (SELECT *, l_quantity * l_extendedprice * (1 - l_discount) AS t FROM lineitem)
GROUP BY 1, 2"""

# --- raw records ------------------------------------------------------------------------

ORACLES["bronze_envelope"] = f"""{_with(SOURCES, LINES)}
SELECT 'bronze' AS zone, source, strftime(ts, {DAY}) AS dt, strftime(ts, '%H') AS hour,
       CAST(event_id AS VARCHAR) AS event_id, user_id, round(value, 4) AS amount,
       source AS envelope_source, topic AS _kafka_topic, event_id AS _kafka_offset,
       '{AUDIT_TIME.replace(" ", "T")}.000000Z' AS _ingested_at, line AS _raw,
       CAST(NULL AS VARCHAR) AS _error_reason
FROM routed WHERE outcome = 'ok'
UNION ALL
SELECT 'dead_letter', source, '{AUDIT_TIME[:10]}', '{AUDIT_TIME[11:13]}', NULL, NULL, NULL, NULL,
       topic, event_id, NULL, line, outcome FROM routed WHERE outcome <> 'ok'"""

ORACLES["json_parse_split"] = f"""{_with(SOURCES, LINES)}
SELECT event_id AS "offset", outcome FROM routed"""

ORACLES["topic_routing"] = f"""{_with(SOURCES, LINES)}
SELECT topic, source, count(*) AS row_count FROM routed GROUP BY 1, 2"""

ORACLES["batch_envelope"] = """
SELECT c_custkey, c_name, 'crm' AS _source, 'customer.parquet' AS _file_path,
       'shoreline_batch_ingest' AS _job, c_name AS raw_name FROM customer"""

# --- streams ------------------------------------------------------------------------------

ORACLES["stream_ingest_available_now"] = f"""{_with(SOURCES, DAY_LINES)}
SELECT source, strftime(ts, {DAY}) AS dt, '00' AS hour,
       CAST(event_id AS VARCHAR) AS event_id, user_id, event_type, round(value, 4) AS amount,
       source AS _source, topic AS _kafka_topic, event_id AS _kafka_offset, line AS _raw
FROM routed WHERE outcome = 'ok'"""

ORACLES["dead_letter"] = f"""{_with(SOURCES, DAY_LINES)}
SELECT source, topic AS _kafka_topic, event_id AS _kafka_offset, outcome AS _error_reason,
       line AS _raw FROM routed WHERE outcome <> 'ok'"""

ORACLES["stream_dedup_watermark"] = f"""
SELECT event_id, user_id, event_type, strftime(ts, {STAMP}) AS ts FROM events"""

# --- batch drops ----------------------------------------------------------------------------

ORACLES["batch_csv_ingest"] = f"""{BASE}
SELECT order_id, customer_id, round(total_amount, 4) AS total_amount, status, order_date,
       'orders' AS _source FROM cust_orders"""

ORACLES["batch_json_array_ingest"] = f"""{BASE}
SELECT payment_id, customer_id, round(amount, 4) AS amount, payment_status, payment_date,
       payment_method AS device, _source FROM pays"""

# --- domain tables ----------------------------------------------------------------------------

ORACLES["silver_events"] = f"""{DOM}
SELECT event_id, event_source, strftime(timestamp, {STAMP}) AS timestamp, user_id, session_id,
       event_type, page_url, referrer, device, browser, country, request_id, method, path,
       status_code, latency_ms, bytes_sent, user_agent, ip_address,
       strftime(_ingested_at, {STAMP}) AS _ingested_at, '{DATE}' AS dt FROM ev_silver"""

ORACLES["silver_transactions"] = f"""{DOM}
SELECT transaction_id, transaction_source, strftime(timestamp, {STAMP}) AS timestamp, user_id,
       txn_type, merchant_id, status, order_id, customer_id, payment_status, gateway,
       round(transaction_fee, 4) AS transaction_fee, round(amount, 4) AS amount, currency,
       payment_method, strftime(_ingested_at, {STAMP}) AS _ingested_at, '{DATE}' AS dt
FROM tx_silver"""

ORACLES["silver_customers"] = f"""{DOM}
SELECT c.customer_id, first_name, 'L' AS last_name, email, CAST(NULL AS VARCHAR) AS phone, segment,
       round(lifetime_value, 4) AS lifetime_value, '2020-01-01' AS registered_date,
       '2026-01-01' AS last_purchase_date, 'crm' AS _source,
       strftime(_ingested_at, {STAMP}) AS _ingested_at, coalesce(n, 0) AS total_orders,
       round(coalesce(total, 0.0), 4) AS total_order_value, latest AS latest_order_date,
       round(coalesce(mean, 0.0), 6) AS avg_order_value, '{DATE}' AS dt
FROM crm_latest c LEFT JOIN by_cust o ON c.customer_id = o.customer_id"""

ORACLES["silver_inventory"] = f"""{DOM}
SELECT sku, product_name, category, warehouse, quantity_on_hand, reorder_point,
       round(unit_cost, 4) AS unit_cost, '2026-04-01' AS last_restock_date,
       '{DATE}' AS snapshot_date, 'inventory' AS _source,
       strftime(_ingested_at, {STAMP}) AS _ingested_at,
       CAST(total_quantity_sold AS BIGINT) AS total_quantity_sold, total_orders,
       round(total_sales_value, 4) AS total_sales_value, stock_status, '{DATE}' AS dt
FROM stock_silver"""

ORACLES["wide_events"] = f"""{WID}
SELECT event_id, user_id, session_id, event_type, page_url, path, method, status_code,
       latency_ms, device, browser, user_agent, ip_address, country,
       strftime(timestamp, {STAMP}) AS timestamp, _source,
       strftime(_ingested_at, {STAMP}) AS _ingested_at, '{DATE}' AS dt FROM ev_wide"""

ORACLES["wide_transactions"] = f"""{WID}
SELECT txn_id, order_id, user_id, customer_id, txn_type, round(amount, 4) AS amount, currency,
       payment_method, payment_status, status, gateway, merchant_id,
       round(transaction_fee, 4) AS transaction_fee, strftime(timestamp, {STAMP}) AS timestamp,
       payment_date, _source, strftime(_ingested_at, {STAMP}) AS _ingested_at, '{DATE}' AS dt
FROM tx_wide"""

ORACLES["wide_customers"] = f"""{DOM}
SELECT c.customer_id, first_name, 'L' AS last_name, email, CAST(NULL AS VARCHAR) AS phone, segment,
       round(lifetime_value, 4) AS lifetime_value, '2020-01-01' AS registered_date,
       '2026-01-01' AS last_purchase_date, n AS total_orders, round(total, 4) AS total_spent,
       'crm' AS _source, strftime(_ingested_at, {STAMP}) AS _ingested_at, '{DATE}' AS dt
FROM crm_latest c LEFT JOIN by_cust o ON c.customer_id = o.customer_id
WHERE email IS NOT NULL"""

ORACLES["wide_customers_orders_only"] = f"""{BASE}
SELECT customer_id, n AS total_orders, round(total, 4) AS total_spent, 'orders' AS _source,
       '{DATE}' AS dt FROM by_cust"""

ORACLES["wide_inventory"] = f"""{WID}
SELECT sku, product_name, category, warehouse, quantity_on_hand, reorder_point,
       round(unit_cost, 4) AS unit_cost, '2026-04-01' AS last_restock_date, orders_count,
       units_sold, 'inventory' AS _source, strftime(_ingested_at, {STAMP}) AS _ingested_at,
       '{DATE}' AS dt FROM stock_wide"""

ORACLES["orders_by_customer"] = f"""{BASE}
SELECT customer_id, n AS total_orders, round(total, 4) AS total_order_value,
       latest AS latest_order_date, round(mean, 6) AS avg_order_value FROM by_cust"""

ORACLES["orders_by_product"] = f"""{BASE}
SELECT product_id, units AS total_quantity_sold, n AS total_orders,
       round(total, 4) AS total_sales_value FROM by_prod"""

ORACLES["left_join_zero_fill"] = f"""{BASE}
SELECT c.customer_id, _file_path, coalesce(n, 0) AS total_orders,
       round(coalesce(total, 0.0), 4) AS total_order_value,
       round(coalesce(mean, 0.0), 6) AS avg_order_value, latest AS latest_order_date
FROM crm c LEFT JOIN by_cust o ON c.customer_id = o.customer_id"""

ORACLES["stock_status"] = f"""{BASE}
SELECT sku, _file_path, quantity_on_hand, reorder_point,
       CASE WHEN quantity_on_hand <= reorder_point THEN 'low_stock'
            WHEN quantity_on_hand <= 0 THEN 'out_of_stock' ELSE 'in_stock' END AS stock_status,
       CASE WHEN quantity_on_hand <= 0 THEN 'out_of_stock'
            WHEN quantity_on_hand <= reorder_point THEN 'low_stock'
            ELSE 'in_stock' END AS strict_status FROM stock"""

# --- KPI tables ---------------------------------------------------------------------------------

ORACLES["daily_activity"] = f"""{_with(SOURCES, DOMAINS, REVENUE)}
SELECT strftime(d, {DAY}) AS event_date, n AS total_events, users AS unique_users FROM act"""

ORACLES["daily_revenue"] = f"""{_with(SOURCES, DOMAINS, REVENUE)}
SELECT strftime(p.d, {DAY}) AS revenue_date, round(total_revenue, 4) AS total_revenue,
       p.n AS total_transactions, round(mean, 4) AS avg_transaction_value,
       people AS unique_customers, round(fees, 4) AS total_fees, a.n AS total_events,
       users AS unique_users, round(p.n / a.n * 100, 4) AS conversion_rate_pct
FROM per_day p LEFT JOIN act a ON p.d = a.d"""

ORACLES["revenue_breakdown"] = f"""{WID},
good AS (SELECT * FROM tx_wide WHERE status = 'completed' OR payment_status = 'success')
SELECT 'overall' AS breakdown_type, 'all' AS breakdown_value,
       round(sum(amount), 2) AS total_revenue, count(txn_id) AS transaction_count,
       round(avg(amount), 2) AS avg_transaction_value, count(DISTINCT user_id) AS unique_customers,
       round(count(*) / (SELECT count(*) FROM ev_wide), 6) AS conversion_rate FROM good
UNION ALL
SELECT 'payment_method', payment_method, round(sum(amount), 2), count(txn_id),
       round(avg(amount), 2), count(DISTINCT user_id), NULL FROM good GROUP BY payment_method
UNION ALL
SELECT 'currency', currency, round(sum(amount), 2), count(txn_id), round(avg(amount), 2),
       count(DISTINCT user_id), NULL FROM good GROUP BY currency"""


def _grid(table: str, head: tuple[str, ...]) -> str:
    return f"""{_with(*head, COHORT_GRID.format(table=table))}
SELECT strftime(g.c, {DAY}) AS cohort_date, CAST(age AS INTEGER) AS days_since_cohort,
       size AS cohort_size, users AS active_users,
       round(users / size * 100, 4) AS retention_rate_pct, n AS total_events
FROM grid g JOIN sizes s ON g.c = s.c"""


ORACLES["retention_grid"] = _grid("ev_silver", (SOURCES, DOMAINS))
ORACLES["retention_grid_in_order"] = _grid("ev_wide", (SOURCES, DOMAINS, WIDE))


def _span(condition: str) -> str:
    marks = ", ".join(
        f"count(*) FILTER (WHERE days >= {m}) AS retained_day_{m}, "
        f"round(count(*) FILTER (WHERE days >= {m}) / nullif(count(user_id), 0) * 100, 2) "
        f"AS retention_day_{m}" for m in (1, 7, 30)
    )
    return f"""{WID}
SELECT strftime(cohort, {DAY}) AS cohort_date, count(user_id) AS cohort_size,
       round(avg(days), 2) AS avg_days_active, round(avg(n), 2) AS avg_events_per_user, {marks}
FROM cohorts WHERE {condition} GROUP BY cohort"""


ORACLES["retention_span"] = _span("TRUE")
ORACLES["retention_span_known_users"] = _span("user_id IS NOT NULL")

ORACLES["sensor_baseline"] = f"""{BASE}
SELECT sensor_type, round(avg(value), 4) AS mean_value, round(stddev_samp(value), 4) AS stddev_value,
       count(reading_id) AS total_readings, round(min(value), 4) AS min_value,
       round(max(value), 4) AS max_value FROM iot GROUP BY sensor_type"""

ORACLES["sensor_bounds"] = f"""{_with(SOURCES, SENSORS)}
SELECT reading_id, sensor_type, round(value, 4) AS value, round(lo, 4) AS lower_bound,
       round(hi, 4) AS upper_bound, coalesce(value < lo OR value > hi, FALSE) AS is_anomaly,
       CASE WHEN value < lo THEN 'below_threshold' WHEN value > hi THEN 'above_threshold'
            ELSE 'normal' END AS anomaly_type, round(abs(z), 4) AS deviation_sigma FROM scored"""

ORACLES["sensor_z_scores"] = f"""{_with(SOURCES, SENSORS)}
SELECT reading_id, sensor_type, round(z, 4) AS z_score, coalesce(abs(z) > 3, FALSE) AS is_anomaly
FROM scored WHERE value IS NOT NULL"""

ORACLES["sensor_anomaly_by_location"] = f"""{_with(SOURCES, SENSORS)}
SELECT sensor_type, location, count(reading_id) AS total_readings,
       count(*) FILTER (WHERE value < lo OR value > hi) AS anomaly_count,
       round(avg(value), 2) AS avg_value, round(max(abs(z)), 2) AS max_deviation_sigma,
       round(max(m), 2) AS baseline_mean, round(max(sd), 2) AS baseline_stddev,
       round(max(lo), 2) AS lower_threshold, round(max(hi), 2) AS upper_threshold,
       round(count(*) FILTER (WHERE value < lo OR value > hi) / count(reading_id) * 100, 2)
         AS anomaly_rate
FROM scored GROUP BY 1, 2"""

SENSOR_DAY = f"""{_with(SOURCES, SENSORS)}
SELECT sensor_type, strftime(CAST(timestamp AS DATE), {DAY}) AS anomaly_date,
       count(reading_id) AS total_readings, count(*) FILTER (WHERE abs(z) > 3) AS anomaly_count,
       round(avg(value), 4) AS avg_sensor_value, round(min(value), 4) AS min_sensor_value,
       round(max(value), 4) AS max_sensor_value, round(avg(z), 4) AS avg_z_score,
       round(max(abs(z)), 4) AS max_abs_z_score,
       round(count(*) FILTER (WHERE abs(z) > 3) / count(reading_id) * 100, {{digits}})
         AS anomaly_rate_pct{{dt}}
FROM scored WHERE value IS NOT NULL GROUP BY 1, 2"""

ORACLES["sensor_anomaly_by_day"] = SENSOR_DAY.format(digits=4, dt="")

ORACLES["product_turnover"] = f"""{DOM}
SELECT sku,
       round(CASE WHEN quantity_on_hand > 0
                  THEN CAST(total_quantity_sold AS DOUBLE) / quantity_on_hand ELSE 0.0 END, 9)
         AS turnover_ratio,
       round(CASE WHEN total_quantity_sold > 0
                  THEN quantity_on_hand / (total_quantity_sold / 30.0) ELSE 999.0 END, 9)
         AS stock_coverage_days,
       quantity_on_hand <= reorder_point AS needs_reorder,
       round(quantity_on_hand * unit_cost, 9) AS stock_value FROM stock_silver"""

ORACLES["inventory_by_category"] = f"""{_with(SOURCES, DOMAINS, TURNOVER)}
SELECT category, products AS product_count, CAST(units AS BIGINT) AS total_stock_units,
       CAST(sold AS BIGINT) AS total_units_sold, round(revenue, 4) AS total_revenue,
       round(turn, 4) AS avg_turnover_ratio, round(worth, 4) AS total_stock_value,
       low AS products_need_reorder, gone AS products_out_of_stock,
       round(low / products * 100, 4) AS reorder_rate_pct,
       round(gone / products * 100, 4) AS stock_out_rate_pct FROM cat"""

ORACLES["inventory_by_category_warehouse"] = f"""{_with(SOURCES, DOMAINS, WIDE, WAREHOUSE)}
SELECT category, warehouse, skus AS total_skus, CAST(units AS BIGINT) AS total_units_on_hand,
       round(worth, 2) AS inventory_value, round(cost, 2) AS avg_unit_cost,
       CAST(sold AS BIGINT) AS units_sold, CAST(n AS BIGINT) AS orders_count,
       round(CASE WHEN worth > 0 THEN cogs / worth ELSE 0.0 END, 4) AS turnover_ratio,
       round(CASE WHEN sold > 0 THEN units / (sold / 30.0) ELSE 999.0 END, 1) AS days_of_supply,
       low AS items_below_reorder, low > 0 AS reorder_alert FROM share"""

ORACLES["cogs_equal_share"] = f"""{_with(SOURCES, DOMAINS, WIDE, WAREHOUSE)}
SELECT category, warehouse, round(cogs, 4) AS cogs_estimate FROM share"""

# --- serving and contracts ------------------------------------------------------------------------


def _num(expression: str, digits: int, name: str) -> str:
    return f"round({expression}, {digits}) AS {name}"


ORACLES["serving_daily_revenue"] = f"""{_with(SOURCES, DOMAINS, REVENUE)}
SELECT strftime(p.d, {DAY}) AS revenue_date, {_num('total_revenue', 2, 'total_revenue')},
       p.n AS total_transactions, {_num('mean', 2, 'avg_transaction_value')},
       people AS unique_customers, {_num('fees', 2, 'total_fees')}, a.n AS total_events,
       users AS unique_users, {_num('p.n / a.n * 100', 2, 'conversion_rate_pct')}, '{DATE}' AS dt
FROM per_day p LEFT JOIN act a ON p.d = a.d"""

ORACLES["serving_user_retention"] = f"""
{_with(SOURCES, DOMAINS, COHORT_GRID.format(table='ev_silver'))}
SELECT strftime(g.c, {DAY}) AS cohort_date, CAST(age AS INTEGER) AS days_since_cohort,
       size AS cohort_size, users AS active_users,
       {_num('users / size * 100', 2, 'retention_rate_pct')}, n AS total_events, '{DATE}' AS dt
FROM grid g JOIN sizes s ON g.c = s.c"""

ORACLES["serving_inventory_turnover"] = f"""{_with(SOURCES, DOMAINS, TURNOVER)}
SELECT category, products AS product_count, CAST(units AS BIGINT) AS total_stock_units,
       CAST(sold AS BIGINT) AS total_units_sold,
       CASE WHEN abs(revenue) < 1e10 THEN round(revenue, 2) END AS total_revenue,
       {_num('turn', 4, 'avg_turnover_ratio')}, {_num('worth', 2, 'total_stock_value')},
       low AS products_need_reorder, gone AS products_out_of_stock,
       {_num('low / products * 100', 2, 'reorder_rate_pct')},
       {_num('gone / products * 100', 2, 'stock_out_rate_pct')}, '{DATE}' AS dt FROM cat"""

ORACLES["serving_sensor_anomaly"] = SENSOR_DAY.format(digits=2, dt=f", '{DATE}' AS dt")

NULLS = """
SELECT 'not_null' AS check_name, 'reading_id' AS column_name,
       count(*) FILTER (WHERE reading_id IS NULL) AS violations FROM iot
UNION ALL SELECT 'not_null', 'sensor_type', count(*) FILTER (WHERE sensor_type IS NULL) FROM iot
UNION ALL SELECT 'not_null', 'value', count(*) FILTER (WHERE {value}) FROM iot"""
TOO_LARGE = "abs(round(value, 2)) >= 100"

ORACLES["contract_not_null"] = f"{BASE} {NULLS.format(value='value IS NULL')}"

ORACLES["contract_primary_key"] = f"""{BASE}
SELECT user_id, event_type, count(*) AS copies FROM deliveries GROUP BY 1, 2 HAVING count(*) > 1"""

ORACLES["contract_numeric"] = f"""{BASE}
SELECT 'numeric' AS check_name, 'value' AS column_name,
       count(*) FILTER (WHERE {TOO_LARGE}) AS violations FROM iot"""

ORACLES["contract_violations"] = f"""{BASE}
{NULLS.format(value="value IS NULL")}
UNION ALL SELECT 'primary_key', 'reading_id', count(*) - count(DISTINCT reading_id) FROM iot
UNION ALL SELECT 'numeric', 'value', count(*) FILTER (WHERE {TOO_LARGE}) FROM iot
UNION ALL SELECT 'length', 'sensor_type', count(*) FILTER (WHERE length(sensor_type) > 5) FROM iot"""

# --- layer checks -----------------------------------------------------------------------------------


def _bronze_row(name: str, table: str, time: str = "_ingested_at") -> str:
    return (f"SELECT 'bronze' AS layer, '{name}' AS table_name, 'ok' AS status, "
            f"count(*) AS row_count, strftime(max({time}), {STAMP}) AS latest, "
            f"CAST(NULL AS VARCHAR) AS error FROM {table}")


BRONZE_ROWS = " UNION ALL ".join([
    _bronze_row("user_events", "user_events"),
    _bronze_row("clickstream", "clickstream"),
    _bronze_row("transactions", "txns"),
    _bronze_row("payments", "pays"),
    _bronze_row("iot_sensors", "iot", "timestamp + INTERVAL 1 MINUTE"),
    _bronze_row("crm", "crm"),
    _bronze_row("inventory", "stock"),
    "SELECT 'bronze', 'orders', 'error', count(*), NULL, 'missing fields: _source, _ingested_at' FROM cust_orders",
    "SELECT 'bronze', 'app_logs', 'missing', 0, NULL, NULL",
])
SILVER_ROWS = " UNION ALL ".join(
    f"SELECT 'silver' AS layer, '{name}' AS table_name, 'ok' AS status, count(*) AS row_count, "
    f"CAST(NULL AS VARCHAR) AS error FROM {table}"
    for name, table in [("events", "ev_silver"), ("transactions", "tx_silver"),
                        ("customers", "crm_latest"), ("inventory", "stock_silver")]
)

ORACLES["bronze_layer_report"] = f"{BASE} {BRONZE_ROWS}"
ORACLES["silver_layer_report"] = f"{DOM} {SILVER_ROWS}"

BOTH_LAYERS = f"""{DOM},
report AS (SELECT layer, status, row_count FROM ({BRONZE_ROWS})
           UNION ALL SELECT layer, status, row_count FROM ({SILVER_ROWS}))"""

ORACLES["layer_verdict"] = f"""{BOTH_LAYERS}
SELECT layer, CAST(sum(row_count) AS BIGINT) AS total_rows,
       bool_and(status IN ('ok', 'missing')) AS passed FROM report GROUP BY layer"""

ORACLES["lineage_ratio"] = f"""{BOTH_LAYERS},
totals AS (SELECT bool_and(status IN ('ok', 'missing')) AS passed,
                  CAST(sum(row_count) FILTER (WHERE layer = 'bronze') AS BIGINT) AS b,
                  CAST(sum(row_count) FILTER (WHERE layer = 'silver') AS BIGINT) AS s FROM report)
SELECT passed, b AS bronze_rows, s AS silver_rows, CAST(0 AS BIGINT) AS gold_rows,
       round(s / b * 100, 4) AS silver_to_bronze_pct FROM totals"""

ORACLES["freshness"] = f"""{BASE}
SELECT count(*) AS row_count, strftime(max(_ingested_at), {STAMP}) AS latest FROM deliveries"""

ORACLES["kpi_profile"] = f"""{_with(SOURCES, DOMAINS, REVENUE)}
SELECT 'daily_activity' AS kpi, 'ok' AS status, count(*) AS row_count, 3 AS column_count,
       CAST(NULL AS VARCHAR) AS latest, count(DISTINCT d) AS date_partitions,
       CAST(NULL AS VARCHAR) AS error FROM act"""

ORACLES["dedup_accounting"] = f"""{DOM},
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id
             ORDER BY _ingested_at DESC, _kafka_offset DESC) AS rn FROM all_events),
counted AS (SELECT count(*) AS before, count(*) FILTER (WHERE rn = 1) AS after,
              count(*) FILTER (WHERE rn = 1 AND event_id IS NOT NULL AND timestamp IS NOT NULL)
                AS kept FROM ranked)
SELECT before AS rows_before, after AS rows_after_dedup, before - after AS duplicates_removed,
       after - kept AS incomplete_dropped, kept AS rows_kept FROM counted"""

# --- lake jobs -----------------------------------------------------------------------------------------

ORACLES["lake_roundtrip_dynamic_overwrite"] = f"""{BASE}
SELECT event_id, event_type,
       round(CASE WHEN CAST(ts AS DATE) = (SELECT CAST(min(ts) AS DATE) FROM ev)
                  THEN value + 1 ELSE value END, 4) AS value,
       strftime(CAST(ts AS DATE), {DAY}) AS dt FROM ev"""


def _counts(rows: list[tuple[str, str, str]], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, {extra}count(*) AS row_count "
        f"FROM ({relation})" for layer, name, relation in rows
    )


# the raw orders of a lake hold both views, so lines without a customer form one more group
JOB_SILVER = [
    ("silver", "events", "SELECT 1 FROM ev_silver"),
    ("silver", "transactions", "SELECT 1 FROM tx_silver"),
    ("silver", "customers", "SELECT 1 FROM crm_latest"),
    ("silver", "inventory", "SELECT 1 FROM stock_latest"),
]
JOB_GOLD = [
    ("gold", "daily_revenue", "SELECT DISTINCT CAST(timestamp AS DATE) FROM tx_silver"),
    ("gold", "user_retention", "SELECT 1 FROM grid"),
    ("gold", "iot_anomaly_summary",
     "SELECT DISTINCT sensor_type, CAST(timestamp AS DATE) FROM iot WHERE value IS NOT NULL"),
    ("gold", "inventory_turnover", "SELECT DISTINCT category FROM stock_latest"),
]
JOB = _with(SOURCES, DOMAINS, COHORT_GRID.format(table="ev_silver"))

ORACLES["daily_job_ledger"] = f"{JOB} {_counts(JOB_SILVER + JOB_GOLD)}"

ORACLES["wide_daily_job_ledger"] = f"""{WID},
good AS (SELECT * FROM tx_wide WHERE status = 'completed' OR payment_status = 'success')
""" + _counts([
    ("silver", "events", "SELECT 1 FROM ev_wide"),
    ("silver", "transactions", "SELECT 1 FROM tx_wide"),
    ("silver", "customers", "SELECT 1 FROM crm_latest WHERE email IS NOT NULL"),
    ("silver", "inventory", "SELECT 1 FROM stock_wide"),
    ("gold", "daily_revenue",
     "SELECT 'all', NULL UNION ALL SELECT DISTINCT 'method', payment_method FROM good "
     "UNION ALL SELECT DISTINCT 'currency', currency FROM good"),
    ("gold", "user_retention", "SELECT DISTINCT cohort FROM cohorts"),
    ("gold", "iot_anomaly_summary", "SELECT DISTINCT sensor_type, location FROM iot"),
    ("gold", "inventory_turnover", "SELECT DISTINCT category, warehouse FROM stock_wide"),
])

JOB_BRONZE = [
    ("bronze", "user_events", "SELECT 1 FROM user_events"),
    ("bronze", "clickstream", "SELECT 1 FROM clickstream"),
    ("bronze", "transactions", "SELECT 1 FROM txns"),
    ("bronze", "payments", "SELECT 1 FROM pays"),
    ("bronze", "iot_sensors", "SELECT 1 FROM iot"),
    ("bronze", "crm", "SELECT 1 FROM crm"),
    ("bronze", "inventory", "SELECT 1 FROM stock"),
    ("bronze", "orders", "SELECT 1 FROM cust_orders UNION ALL SELECT 1 FROM prod_orders"),
]
ORACLES["lake_validation"] = f"""{JOB}
{_counts(JOB_BRONZE + JOB_SILVER + JOB_GOLD, extra="'ok' AS status, ")}
UNION ALL SELECT 'bronze', 'app_logs', 'missing', 0"""

ORACLES["gold_verification"] = f"""{JOB},
counted AS ({_counts(JOB_GOLD)})
SELECT table_name AS kpi, 'ok' AS status, row_count,
       CASE table_name WHEN 'daily_revenue' THEN 11 WHEN 'user_retention' THEN 8
                       WHEN 'inventory_turnover' THEN 13 ELSE 12 END AS column_count,
       CAST(1 AS BIGINT) AS date_partitions, CAST(NULL AS VARCHAR) AS error FROM counted"""
