"""DuckDB oracle SQL for every batch query in ``kpiflow.plans.catalog``.

The oracle is written independently of the Spark code: it derives every
fixture field and the route of every record from ``event_id`` (FIXTURES.md),
without parsing any JSON, then expresses each query in plain SQL over the
pre-registered ``events`` view. Doubles are rounded to 6 decimals and counts
cast to BIGINT, as on the Spark side.
"""

from __future__ import annotations

T0 = 1704067200000000
FACTOR = 144

FIXTURE = f"""
ev AS (
  SELECT event_id AS m, user_id AS u, ts, event_type AS et, value,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         make_timestamp({T0} + (epoch_us(ts) - {T0}) // {FACTOR}) AS etime
  FROM events
),
b1 AS (
  SELECT *,
    CASE WHEN et = 'purchase' THEN 'orders' ELSE 'clickstream' END AS source_name,
    CASE WHEN m % 10 = 3 THEN NULL WHEN m % 10 = 4 THEN ''
         WHEN k < 28 THEN 'organic' WHEN k < 52 THEN 'paid_search' WHEN k < 68 THEN 'social'
         WHEN k < 82 THEN 'email' WHEN k < 92 THEN 'affiliate' ELSE 'direct' END AS raw_channel,
    CASE WHEN m % 25 = 0 THEN 'truncated' WHEN m % 500 = 41 THEN 'blank' WHEN m % 25 = 12 THEN 'null_id'
         WHEN m % 200 = 31 THEN 'bad_time' WHEN m % 200 = 57 THEN 'bad_type'
         WHEN m % 200 = 83 THEN 'version_text' WHEN m % 200 = 107 THEN 'version_fraction' WHEN m % 200 = 133 THEN 'version_boolean'
         WHEN m % 200 = 157 THEN 'id_number' WHEN m % 200 = 181 THEN 'user_object' WHEN m % 200 = 71 THEN 'leading_space'
         WHEN m % 200 = 95 THEN 'key_twice' ELSE 'none' END AS fault
  FROM ev
),
f1 AS (
  SELECT source_name, m, k, u, fault, etime, ts,
    fault IN ('truncated', 'blank') AS parse_failed,
    fault IN ('bad_type', 'version_text', 'version_fraction', 'version_boolean') AS version_wrong,
    CASE WHEN fault IN ('truncated', 'blank', 'null_id', 'id_number') THEN NULL
         ELSE (CASE WHEN source_name = 'orders' THEN 'ord_' ELSE 'evt_' END) || lpad(CAST(m AS VARCHAR), 10, '0') END AS rid,
    CASE WHEN fault IN ('truncated', 'blank', 'bad_time') THEN NULL ELSE etime END AS event_time,
    'sess_' || lpad(CAST(u AS VARCHAR), 6, '0') || '_' || strftime(ts, '%Y%m%d') AS session_id,
    CASE WHEN fault <> 'user_object' THEN 'usr_' || lpad(CAST(u AS VARCHAR), 6, '0') END AS user_id,
    CASE WHEN m % 97 = 0 THEN 'unknown_evt'
         WHEN et = 'view' THEN CASE WHEN m % 2 = 0 THEN 'page_view' ELSE 'product_view' END
         WHEN et = 'click' THEN CASE WHEN m % 3 = 0 THEN 'add_to_cart' ELSE 'search' END
         WHEN et = 'signup' THEN 'checkout_started' WHEN et = 'error' THEN 'ad_click' END AS event_type,
    raw_channel AS channel,
    CASE WHEN raw_channel IS NULL OR raw_channel = '' THEN
           CASE (m // 10) % 5 WHEN 0 THEN NULL WHEN 1 THEN 'https://www.Google.com/s' WHEN 2 THEN 'https://bing.com'
                WHEN 3 THEN 'https://m.facebook.com/ad' ELSE 'https://partner.example.com' END
         ELSE 'https://ref.example.com' END AS referrer,
    CASE WHEN raw_channel IS NULL OR raw_channel = '' OR raw_channel = 'direct' THEN NULL
         ELSE 'cmp_' || CAST(1000 + u % 20 AS VARCHAR) END AS campaign_id,
    CASE WHEN m % 101 = 0 THEN NULL ELSE (['mobile', 'desktop', 'tablet'])[k % 3 + 1] END AS device_type,
    (['US', 'IN', 'GB', 'DE', 'AU', 'SG'])[m % 6 + 1] AS country_code,
    'https://shop.example.com/p/' || CAST(k AS VARCHAR) AS page_url,
    'prd_' || lpad(CAST(k AS VARCHAR), 4, '0') AS product_id,
    (['apparel', 'electronics', 'home', 'beauty', 'sports'])[k % 5 + 1] AS category,
    CASE WHEN k < 18 THEN 'authorized' WHEN k < 90 THEN 'captured' WHEN k < 95 THEN 'declined' ELSE 'refunded' END AS status,
    (['card', 'wallet', 'upi', 'paypal'])[k % 4 + 1] AS payment_method,
    'USD' AS currency,
    value AS order_value,
    CAST(1 + m % 5 AS INTEGER) AS items_count,
    k / 100.0 AS fraud_score,
    CASE WHEN fault IN ('bad_type', 'version_text', 'version_fraction', 'version_boolean') THEN NULL ELSE 1 END AS schema_version,
    CAST(u % (CASE WHEN source_name = 'orders' THEN 12 ELSE 24 END) AS INTEGER) AS kafka_partition,
    CASE WHEN fault IN ('truncated', 'blank') THEN 'json_parse_failure'
         WHEN fault IN ('null_id', 'bad_time') THEN 'required_fields_missing'
         WHEN fault IN ('bad_type', 'version_text', 'version_fraction', 'version_boolean', 'id_number', 'user_object') THEN 'type_mismatch'
         ELSE 'valid' END AS route
  FROM b1
),
f2 AS (
  SELECT f1.*,
    CASE WHEN parse_failed THEN 'json_parse_failure'
         WHEN fault = 'null_id' OR (source_name = 'clickstream' AND (channel IS NULL OR channel = '' OR device_type IS NULL))
           THEN 'required_fields_missing'
         WHEN version_wrong OR fault IN ('bad_time', 'id_number', 'user_object') THEN 'type_mismatch'
         ELSE 'valid' END AS strict_route,
    CASE WHEN channel IS NOT NULL AND channel <> '' THEN channel
         WHEN referrer IS NULL OR referrer = '' THEN 'direct'
         WHEN lower(referrer) LIKE '%google%' OR lower(referrer) LIKE '%bing%' THEN 'organic'
         WHEN lower(referrer) LIKE '%facebook%' OR lower(referrer) LIKE '%instagram%' OR lower(referrer) LIKE '%tiktok%' THEN 'social'
         ELSE 'affiliate' END AS channel_normalized
  FROM f1
),
sent AS (
  SELECT f2.*, r.replay,
    etime + to_microseconds(CAST(m % 120 + r.replay * 300 + CASE WHEN m % 300 = 77 THEN 7200 ELSE 0 END AS BIGINT) * 1000000)
      AS kafka_ingest_time
  FROM f2, (SELECT unnest([0, 1]) AS replay) r
  WHERE r.replay = 0 OR m % 50 = 9
),
fx AS (
  SELECT *, session_id AS kafka_key,
    CAST(row_number() OVER (PARTITION BY source_name, kafka_partition ORDER BY kafka_ingest_time, m, replay) - 1 AS BIGINT)
      AS kafka_offset
  FROM sent
)"""



def resent(sql: str) -> str:
    """The same query over the landing table of the live replays: m % 60 = 37 comes again two hours later, at another event time and with another status."""
    changed = sql.replace("""  SELECT f2.*, r.replay,
    etime + to_microseconds(CAST(m % 120 + r.replay * 300 +""", """  SELECT f2.* REPLACE (
      CASE WHEN r.replay = 2 THEN event_time + INTERVAL 2 HOUR ELSE event_time END AS event_time,
      CASE WHEN r.replay < 2 THEN status WHEN status = 'captured' THEN 'refunded' ELSE 'captured' END AS status), r.replay,
    etime + CASE WHEN r.replay = 2 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END
      + to_microseconds(CAST(m % 120 + CASE WHEN r.replay = 1 THEN 300 ELSE 0 END +""")
    return changed.replace(
        "unnest([0, 1]) AS replay) r\n  WHERE r.replay = 0 OR m % 50 = 9",
        "unnest([0, 1, 2]) AS replay) r\n  WHERE r.replay = 0 OR r.replay = 1 AND m % 50 = 9 OR r.replay = 2 AND m % 60 = 37 AND fault = 'none'")


INTENT = """CASE WHEN {ov} IS NOT NULL AND NOT isnan({ov}) AND {ov} <> 0
       THEN least(CAST(1.0 AS DOUBLE), {base} + least({ov} / 500.0, CAST(0.2 AS DOUBLE)))
       ELSE {base} END"""
INTENT_BASE = """CAST(CASE {et} WHEN 'page_view' THEN 0.15 WHEN 'search' THEN 0.25 WHEN 'product_view' THEN 0.45
       WHEN 'add_to_cart' THEN 0.75 WHEN 'checkout_started' THEN 0.9 ELSE 0.1 END AS DOUBLE)"""

SILVER = """
dc AS (
  SELECT * FROM fx WHERE source_name = 'clickstream' AND route = 'valid' AND replay = 0
),
dor AS (
  SELECT * FROM fx WHERE source_name = 'orders' AND route = 'valid' AND replay = 0
     AND status IN ('authorized', 'captured', 'declined')
),
silver AS (
  SELECT c.event_time, c.event_id, c.event_type, c.session_id, c.user_id, c.product_id, c.category, c.campaign_id,
    c.channel, c.device_type, c.country_code, o.order_id, o.order_status, o.order_value, o.payment_method,
    """ + INTENT.format(ov="o.order_value", base=INTENT_BASE.format(et="c.event_type")) + """ AS session_intent_score,
    CAST(c.event_time AS DATE) AS event_date, strftime(c.event_time, '%H') AS event_hour,
    strftime(c.event_time, '%M') AS event_minute
  FROM (SELECT event_time, rid AS event_id, event_type, session_id, user_id, product_id, category, campaign_id,
               channel_normalized AS channel, device_type, country_code FROM dc) c
  LEFT JOIN (SELECT rid AS order_id, event_time AS o_time, session_id, user_id, status AS order_status, order_value,
                    payment_method FROM dor) o
    ON c.session_id = o.session_id AND c.user_id = o.user_id
   AND o.o_time >= c.event_time AND o.o_time <= c.event_time + INTERVAL 45 MINUTE
),
kpis AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start,
    time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE AS window_end,
    channel, device_type, country_code,
    count(*) AS events_total,
    count(DISTINCT session_id) AS sessions_total,
    CAST(sum(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS cart_adds,
    count(DISTINCT order_id) AS orders_total,
    sum(CASE WHEN order_status = 'captured' THEN order_value ELSE CAST(0.0 AS DOUBLE) END) AS gross_revenue,
    avg(CAST(session_intent_score AS DECIMAL(20,10))) AS avg_session_intent,
    CASE WHEN count(DISTINCT session_id) = 0 THEN CAST(0.0 AS DOUBLE)
         ELSE count(DISTINCT order_id) / count(DISTINCT session_id) END AS conversion_rate
  FROM silver GROUP BY 1, 2, 3, 4, 5
)"""


def sliding(ts: str, length_min: int, slide_min: int) -> str:
    """Window starts of a sliding window, one row per (input, window)."""
    n = length_min // slide_min
    return (
        f"time_bucket(INTERVAL {slide_min} MINUTE, {ts}) - to_minutes(CAST(w.i * {slide_min} AS BIGINT))",
        f"range(0, {n}) w(i)",
    )


def quality_sql(source: str, entity_name: str, ts: str, id_col: str, valid_expr: str, from_: str) -> str:
    ws, rng = sliding(ts, 5, 1)
    return f"""
  SELECT '{entity_name}' AS entity_name, ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end,
    count(*) AS records_total,
    CAST(sum(CASE WHEN {id_col} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_id_count,
    CAST(count({id_col}) - count(DISTINCT {id_col}) AS BIGINT) AS duplicate_count,
    CAST(sum(CASE WHEN NOT ({valid_expr}) THEN 1 ELSE 0 END) AS BIGINT) AS invalid_records,
    CASE WHEN count(*) = 0 THEN 0.0 ELSE sum(CASE WHEN {id_col} IS NULL THEN 1 ELSE 0 END) / count(*) END AS null_ratio,
    CASE WHEN count(*) = 0 THEN 0.0 ELSE (count({id_col}) - count(DISTINCT {id_col})) / count(*) END AS duplicate_ratio
  FROM (SELECT q.*, {ws} AS ws FROM ({from_}) q, {rng}) GROUP BY ws"""


BRONZE_QUALITY_CLICKS = quality_sql(
    "clickstream", "clickstream_bronze", "coalesce(event_time, kafka_ingest_time)", "rid",
    "rid IS NOT NULL AND event_time IS NOT NULL",
    "SELECT * FROM fx WHERE source_name = 'clickstream' AND NOT parse_failed",
)
BRONZE_QUALITY_ORDERS = quality_sql(
    "orders", "orders_bronze", "coalesce(event_time, kafka_ingest_time)", "rid",
    "rid IS NOT NULL AND event_time IS NOT NULL",
    "SELECT * FROM fx WHERE source_name = 'orders' AND NOT parse_failed",
)
JOINED_QUALITY = quality_sql("silver", "joined_stream", "event_time", "event_id", "TRUE", "SELECT * FROM silver")

ALERTS = f"""
alerts AS (
  SELECT *, CASE WHEN null_ratio > 0.02 OR duplicate_ratio > 0.005 THEN 'critical' ELSE 'normal' END AS alert_level
  FROM ({BRONZE_QUALITY_CLICKS}
  UNION ALL {BRONZE_QUALITY_ORDERS}
  UNION ALL {JOINED_QUALITY})
)"""

STRICT_TOTALS = """
sc AS (SELECT * FROM fx WHERE source_name = 'clickstream' AND strict_route = 'valid'),
so AS (SELECT * FROM fx WHERE source_name = 'orders' AND strict_route = 'valid'),
per_key AS (
  SELECT session_id, user_id, count(*) AS matched_orders,
    sum(CASE WHEN status = 'captured' THEN order_value ELSE CAST(0.0 AS DOUBLE) END) AS matched_captured_value
  FROM so GROUP BY 1, 2
),
totals AS (
  SELECT sc.*, CAST(coalesce(p.matched_orders, 0) AS BIGINT) AS matched_orders,
    CAST(coalesce(p.matched_captured_value, 0.0) AS DOUBLE) AS matched_captured_value
  FROM sc LEFT JOIN per_key p ON sc.session_id = p.session_id AND sc.user_id = p.user_id
)"""

ARR = """
arr AS (
  SELECT source_name, kafka_ingest_time, kafka_partition, kafka_offset, event_time, route,
    CASE WHEN parse_failed THEN NULL WHEN source_name = 'clickstream' THEN event_type ELSE status END AS label
  FROM fx
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


CLICK_CONTRACT = """list_filter([
      CASE WHEN fault = 'null_id' THEN 'event_id:required' END,
      CASE WHEN event_type IS NULL THEN 'event_type:required' END,
      CASE WHEN session_id IS NULL THEN 'session_id:required' END,
      CASE WHEN page_url IS NULL THEN 'page_url:required' END,
      CASE WHEN channel IS NULL THEN 'channel:required' END,
      CASE WHEN device_type IS NULL THEN 'device_type:required' END,
      CASE WHEN country_code IS NULL THEN 'country_code:required' END,
      CASE WHEN fault = 'id_number' THEN 'event_id:type' END,
      CASE WHEN fault = 'user_object' THEN 'user_id:type' END,
      CASE WHEN version_wrong THEN 'schema_version:type' END,
      CASE WHEN fault = 'bad_time' THEN 'event_time:format' END,
      CASE WHEN length(rid) < 10 THEN 'event_id:minLength' END,
      CASE WHEN event_type NOT IN ('page_view', 'product_view', 'add_to_cart', 'checkout_started', 'search', 'ad_click')
           THEN 'event_type:enum' END,
      CASE WHEN length(session_id) < 8 THEN 'session_id:minLength' END,
      CASE WHEN length(user_id) < 8 THEN 'user_id:minLength' END,
      CASE WHEN channel NOT IN ('organic', 'paid_search', 'social', 'email', 'affiliate', 'direct') THEN 'channel:enum' END,
      CASE WHEN device_type NOT IN ('mobile', 'desktop', 'tablet') THEN 'device_type:enum' END,
      CASE WHEN length(country_code) < 2 THEN 'country_code:minLength' END,
      CASE WHEN length(country_code) > 2 THEN 'country_code:maxLength' END,
      CASE WHEN schema_version < 1 THEN 'schema_version:minimum' END
    ], lambda x: x IS NOT NULL)"""

ORDER_CONTRACT = """list_filter([
      CASE WHEN fault = 'null_id' THEN 'order_id:required' END,
      CASE WHEN session_id IS NULL THEN 'session_id:required' END,
      CASE WHEN status IS NULL THEN 'status:required' END,
      CASE WHEN payment_method IS NULL THEN 'payment_method:required' END,
      CASE WHEN currency IS NULL THEN 'currency:required' END,
      CASE WHEN order_value IS NULL THEN 'order_value:required' END,
      CASE WHEN fault = 'id_number' THEN 'order_id:type' END,
      CASE WHEN fault = 'user_object' THEN 'user_id:type' END,
      CASE WHEN version_wrong THEN 'schema_version:type' END,
      CASE WHEN fault = 'bad_time' THEN 'event_time:format' END,
      CASE WHEN length(rid) < 10 THEN 'order_id:minLength' END,
      CASE WHEN length(session_id) < 8 THEN 'session_id:minLength' END,
      CASE WHEN length(user_id) < 8 THEN 'user_id:minLength' END,
      CASE WHEN status NOT IN ('authorized', 'captured', 'declined', 'refunded') THEN 'status:enum' END,
      CASE WHEN payment_method NOT IN ('card', 'wallet', 'upi', 'paypal') THEN 'payment_method:enum' END,
      CASE WHEN length(currency) < 3 THEN 'currency:minLength' END,
      CASE WHEN length(currency) > 3 THEN 'currency:maxLength' END,
      CASE WHEN order_value < 0 THEN 'order_value:minimum' END,
      CASE WHEN items_count < 1 THEN 'items_count:minimum' END,
      CASE WHEN fraud_score < 0 THEN 'fraud_score:minimum' END,
      CASE WHEN fraud_score > 1 THEN 'fraud_score:maximum' END,
      CASE WHEN length(country_code) < 2 THEN 'shipping_country:minLength' END,
      CASE WHEN length(country_code) > 2 THEN 'shipping_country:maxLength' END,
      CASE WHEN schema_version < 1 THEN 'schema_version:minimum' END
    ], lambda x: x IS NOT NULL)"""

CLICK_MISSING = """list_filter([
      CASE WHEN fault = 'null_id' THEN 'event_id' END,
      CASE WHEN event_type IS NULL OR event_type = '' THEN 'event_type' END,
      CASE WHEN session_id IS NULL OR session_id = '' THEN 'session_id' END,
      CASE WHEN page_url IS NULL OR page_url = '' THEN 'page_url' END,
      CASE WHEN channel IS NULL OR channel = '' THEN 'channel' END,
      CASE WHEN device_type IS NULL OR device_type = '' THEN 'device_type' END,
      CASE WHEN country_code IS NULL OR country_code = '' THEN 'country_code' END
    ], lambda x: x IS NOT NULL)"""

ORDER_MISSING = """list_filter([
      CASE WHEN fault = 'null_id' THEN 'order_id' END,
      CASE WHEN session_id IS NULL OR session_id = '' THEN 'session_id' END,
      CASE WHEN status IS NULL OR status = '' THEN 'status' END,
      CASE WHEN payment_method IS NULL OR payment_method = '' THEN 'payment_method' END,
      CASE WHEN currency IS NULL OR currency = '' THEN 'currency' END,
      CASE WHEN order_value IS NULL THEN 'order_value' END,
      CASE WHEN items_count IS NULL THEN 'items_count' END,
      CASE WHEN fraud_score IS NULL THEN 'fraud_score' END
    ], lambda x: x IS NOT NULL)"""


def _campaign() -> str:
    ws, rng = sliding("event_time", 5, 1)
    return f"""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, campaign_id, channel,
  count(*) AS campaign_events, count(DISTINCT order_id) AS campaign_orders,
  {_r("sum(coalesce(order_value, CAST(0.0 AS DOUBLE)))", "campaign_revenue")}
FROM (SELECT s.*, {ws} AS ws FROM silver s, {rng}) GROUP BY ws, campaign_id, channel"""


def _drift() -> str:
    ws, rng = sliding("event_time", 10, 2)
    return f"""
, counts AS (
  SELECT ws, channel, count(*) AS channel_events
  FROM (SELECT s.*, {ws} AS ws FROM silver s, {rng}) GROUP BY ws, channel
), d AS (
  SELECT ws, channel, channel_events,
    channel_events / sum(channel_events) OVER (PARTITION BY ws) AS observed_ratio,
    CAST(CASE channel WHEN 'organic' THEN 0.28 WHEN 'paid_search' THEN 0.24 WHEN 'social' THEN 0.16
         WHEN 'email' THEN 0.14 WHEN 'affiliate' THEN 0.10 WHEN 'direct' THEN 0.08 ELSE 0.0 END AS DOUBLE) AS expected_ratio
  FROM counts
)
SELECT 'channel_mix' AS entity_name, ws AS window_start, ws + INTERVAL 10 MINUTE AS window_end, channel, channel_events,
  {_r("observed_ratio", "observed_ratio")}, {_r("expected_ratio", "expected_ratio")},
  {_r("abs(observed_ratio - expected_ratio)", "drift_score")}
FROM d"""


def _unknown() -> str:
    ws, rng = sliding("event_time", 5, 1)
    return f"""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, count(*) AS records_total,
  CAST(sum(CASE WHEN event_type IS NULL OR event_type NOT IN
      ('page_view', 'product_view', 'add_to_cart', 'checkout_started', 'search', 'ad_click') THEN 1 ELSE 0 END) AS BIGINT)
    AS unknown_event_types,
  {_r("sum(CASE WHEN event_type IS NULL OR event_type NOT IN ('page_view', 'product_view', 'add_to_cart', 'checkout_started', 'search', 'ad_click') THEN 1 ELSE 0 END) / count(*)", "unknown_event_ratio")},
  CASE WHEN sum(CASE WHEN event_type IS NULL OR event_type NOT IN
      ('page_view', 'product_view', 'add_to_cart', 'checkout_started', 'search', 'ad_click') THEN 1 ELSE 0 END) / count(*) > 0.001
    THEN 'critical' ELSE 'normal' END AS alert_level
FROM (SELECT q.*, {ws} AS ws FROM (SELECT * FROM fx WHERE source_name = 'clickstream' AND route = 'valid') q, {rng})
GROUP BY ws"""


QUALITY_COLS = (
    "entity_name, window_start, window_end, records_total, null_id_count, duplicate_count, invalid_records, "
    + _r("null_ratio", "null_ratio") + ", " + _r("duplicate_ratio", "duplicate_ratio")
)


def oracle_sql() -> dict[str, str]:
    fx = _with(FIXTURE)
    sv = _with(FIXTURE, SILVER)
    q: dict[str, str] = {}
    q["raw_route_counts"] = fx + "\nSELECT source_name, route, count(*) AS records FROM fx GROUP BY 1, 2"
    # a blank payload is a blank line, which the scan skips
    q["json_lines_routes"] = fx + "\nSELECT source_name, route, count(*) AS records FROM fx WHERE fault <> 'blank' GROUP BY 1, 2"
    q["bronze_valid_clicks"] = fx + """
SELECT rid AS event_id, event_time, event_type, session_id, user_id, channel, referrer, campaign_id, device_type,
  country_code, schema_version, kafka_key, kafka_ingest_time, kafka_partition, kafka_offset,
  CAST(0 AS INTEGER) AS null_required_columns, TRUE AS is_record_valid, source_name,
  CAST(event_time AS DATE) AS event_date, strftime(event_time, '%H') AS event_hour, strftime(event_time, '%M') AS event_minute
FROM fx WHERE source_name = 'clickstream' AND route = 'valid'"""
    q["quarantine"] = fx + """
SELECT source_name, route AS error_reason, kafka_key, kafka_ingest_time, kafka_partition, kafka_offset,
  rid AS record_id, event_time,
  CAST(coalesce(event_time, kafka_ingest_time) AS DATE) AS event_date,
  strftime(coalesce(event_time, kafka_ingest_time), '%H') AS event_hour
FROM fx WHERE route <> 'valid'"""
    q["contract_violations"] = fx + f"""
, v AS (
  SELECT source_name, rid, kafka_partition, kafka_offset,
    CASE WHEN source_name = 'clickstream' THEN {CLICK_CONTRACT} ELSE {ORDER_CONTRACT} END AS vl
  FROM fx WHERE NOT parse_failed
)
SELECT source_name, rid AS record_id, kafka_partition, kafka_offset, CAST(len(vl) AS INTEGER) AS violation_count,
  array_to_string(vl, ',') AS violations
FROM v WHERE len(vl) > 0"""
    q["missing_fields"] = fx + f"""
, v AS (
  SELECT source_name, rid, kafka_partition, kafka_offset,
    CASE WHEN source_name = 'clickstream' THEN {CLICK_MISSING} ELSE {ORDER_MISSING} END AS ml
  FROM fx WHERE NOT parse_failed
)
SELECT source_name, rid AS record_id, kafka_partition, kafka_offset, array_to_string(ml, ',') AS missing_fields
FROM v WHERE len(ml) > 0"""
    q["dedup_clicks"] = sv + """
SELECT rid AS event_id, event_time, session_id, user_id, channel_normalized, kafka_ingest_time, kafka_partition,
  kafka_offset FROM dc"""
    q["dedup_orders"] = sv + """
SELECT rid AS order_id, event_time, session_id, user_id, status, round(order_value, 6) AS order_value,
  kafka_ingest_time, kafka_partition, kafka_offset FROM dor"""
    q["channel_normalized"] = sv + "\nSELECT channel_normalized, count(*) AS clicks FROM dc GROUP BY 1"
    q["intent_score"] = sv + """
SELECT event_id, order_id, event_type, round(order_value, 6) AS order_value,
  round(session_intent_score, 6) AS session_intent_score FROM silver"""
    q["session_attribution"] = sv + """
SELECT event_time, event_id, event_type, session_id, user_id, product_id, category, campaign_id, channel, device_type,
  country_code, order_id, order_status, round(order_value, 6) AS order_value, payment_method,
  round(session_intent_score, 6) AS session_intent_score, event_date, event_hour, event_minute FROM silver"""
    q["attribution_last_touch"] = sv + """
, pairs AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_time DESC, event_id DESC) AS rn
  FROM silver WHERE order_id IS NOT NULL
)
SELECT order_id, event_id, event_time, session_id, channel, order_status, round(order_value, 6) AS order_value
FROM pairs WHERE rn = 1"""
    q["session_order_totals"] = _with(FIXTURE, STRICT_TOTALS) + """
SELECT rid AS event_id, session_id, kafka_partition, kafka_offset, matched_orders,
  round(matched_captured_value, 6) AS matched_captured_value FROM totals"""
    q["realtime_kpis"] = sv + f"""
SELECT window_start, window_end, channel, device_type, country_code, events_total, sessions_total, cart_adds,
  orders_total, {_r("gross_revenue", "gross_revenue")}, {_r("avg_session_intent", "avg_session_intent")},
  {_r("conversion_rate", "conversion_rate")} FROM kpis"""
    q["campaign_sliding"] = sv + _campaign()
    q["quality_clicks"] = fx + f"\nSELECT {QUALITY_COLS} FROM ({BRONZE_QUALITY_CLICKS})"
    q["quality_orders"] = fx + f"\nSELECT {QUALITY_COLS} FROM ({BRONZE_QUALITY_ORDERS})"
    q["quality_alerts"] = _with(FIXTURE, SILVER, ALERTS) + f"\nSELECT {QUALITY_COLS}, alert_level FROM alerts"
    q["unknown_event_ratio"] = fx + _unknown()
    q["channel_drift"] = sv + _drift()
    q["minute_kpis_unbounded"] = _with(FIXTURE, STRICT_TOTALS) + """
, g AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start, channel, device_type, country_code,
    count(*) AS events_total, count(DISTINCT session_id) AS sessions_total,
    CAST(sum(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS cart_adds,
    CAST(sum(matched_orders) AS BIGINT) AS orders_total, sum(matched_captured_value) AS gross_revenue
  FROM totals GROUP BY 1, 2, 3, 4
)
SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, channel, device_type, country_code,
  events_total, sessions_total, cart_adds, orders_total, round(gross_revenue, 2) AS gross_revenue,
  round(least(CAST(1.0 AS DOUBLE), CAST(0.15 AS DOUBLE) + CASE WHEN orders_total > 0 THEN CAST(0.2 AS DOUBLE) ELSE 0.0 END
        + CASE WHEN cart_adds > 0 THEN CAST(0.1 AS DOUBLE) ELSE 0.0 END), 3) AS avg_session_intent,
  round(CASE WHEN sessions_total = 0 THEN 0.0 ELSE orders_total / sessions_total END, 4) AS conversion_rate
FROM g ORDER BY window_start, channel"""
    q["run_summary"] = fx + """
, s AS (
  SELECT
    CAST(sum(CASE WHEN source_name = 'clickstream' THEN 1 ELSE 0 END) AS BIGINT) AS clickstream_generated,
    CAST(sum(CASE WHEN source_name = 'orders' THEN 1 ELSE 0 END) AS BIGINT) AS orders_generated,
    CAST(sum(CASE WHEN source_name = 'clickstream' AND strict_route = 'valid' THEN 1 ELSE 0 END) AS BIGINT) AS clickstream_valid,
    CAST(sum(CASE WHEN source_name = 'orders' AND strict_route = 'valid' THEN 1 ELSE 0 END) AS BIGINT) AS orders_valid,
    CAST(sum(CASE WHEN strict_route <> 'valid' THEN 1 ELSE 0 END) AS BIGINT) AS quarantine_records,
    CAST(sum(CASE WHEN source_name = 'orders' AND strict_route = 'valid' AND status = 'captured' THEN 1 ELSE 0 END) AS BIGINT)
      AS captured_orders,
    sum(CASE WHEN source_name = 'orders' AND strict_route = 'valid' AND status = 'captured' THEN order_value END) AS revenue,
    count(DISTINCT CASE WHEN source_name = 'clickstream' AND strict_route = 'valid' THEN session_id END) AS sessions,
    max(CASE WHEN source_name = 'clickstream' AND strict_route = 'valid' THEN date_trunc('minute', event_time) END)
      AS window_start
  FROM fx
)
SELECT clickstream_generated, orders_generated, clickstream_valid, orders_valid, quarantine_records, captured_orders,
  round(round(coalesce(revenue, 0.0), 2), 6) AS gross_revenue,
  round(round(CASE WHEN sessions = 0 THEN 0.0 ELSE captured_orders / sessions END, 4), 6) AS conversion_rate,
  'offline_demo' AS entity_name, window_start, window_start + INTERVAL 1 MINUTE AS window_end,
  clickstream_valid + orders_valid AS records_total, quarantine_records AS invalid_records,
  CASE WHEN quarantine_records > 0 THEN 'critical' ELSE 'normal' END AS alert_level
FROM s"""
    q["top_campaigns"] = fx + """
SELECT campaign_id, channel, count(*) AS campaign_events
FROM fx WHERE source_name = 'clickstream' AND strict_route = 'valid'
GROUP BY 1, 2 ORDER BY campaign_events DESC, campaign_id ASC NULLS FIRST, channel ASC NULLS FIRST LIMIT 10"""
    q["latest_alerts"] = _with(FIXTURE, SILVER, ALERTS) + f"""
SELECT {QUALITY_COLS}, alert_level FROM alerts ORDER BY window_end DESC, entity_name ASC LIMIT 25"""
    q["latest_window_rollup"] = sv + f"""
SELECT window_end, CAST(sum(events_total) AS BIGINT) AS events_total, CAST(sum(orders_total) AS BIGINT) AS orders_total,
  {_r("sum(gross_revenue)", "gross_revenue")}, CAST(sum(sessions_total) AS BIGINT) AS sessions_total,
  {_r("CASE WHEN sum(sessions_total) = 0 THEN 0.0 ELSE sum(orders_total) / sum(sessions_total) END", "conversion_rate")}
FROM kpis WHERE window_end = (SELECT max(window_end) FROM kpis) GROUP BY window_end"""
    q["revenue_by_channel"] = sv + f"""
SELECT channel, {_r("sum(gross_revenue)", "gross_revenue")} FROM kpis GROUP BY channel ORDER BY 2 DESC"""
    q["conversion_trend"] = sv + f"""
SELECT window_start, {_r("avg(CAST(conversion_rate AS DECIMAL(30,15)))", "conversion_rate")},
  {_r("avg(CAST(gross_revenue AS DECIMAL(30,10)))", "gross_revenue")}
FROM kpis GROUP BY window_start ORDER BY window_start"""
    q["throughput"] = _with(FIXTURE, ARR) + """
SELECT source_name, time_bucket(INTERVAL 1 MINUTE, kafka_ingest_time) AS window_start,
  time_bucket(INTERVAL 1 MINUTE, kafka_ingest_time) + INTERVAL 1 MINUTE AS window_end, label, count(*) AS records
FROM arr GROUP BY 1, 2, 3, 4"""
    q["error_rate"] = _with(FIXTURE, ARR) + f"""
SELECT source_name, time_bucket(INTERVAL 5 MINUTE, kafka_ingest_time) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, kafka_ingest_time) + INTERVAL 5 MINUTE AS window_end,
  count(*) AS records_total, CAST(sum(CASE WHEN route <> 'valid' THEN 1 ELSE 0 END) AS BIGINT) AS quarantined,
  {_r("sum(CASE WHEN route <> 'valid' THEN 1 ELSE 0 END) / count(*)", "error_rate")}
FROM arr GROUP BY 1, 2, 3"""
    q["high_watermark"] = _with(FIXTURE, ARR) + """
, per_min AS (
  SELECT source_name, date_trunc('minute', kafka_ingest_time) AS mi, count(*) AS n FROM arr GROUP BY 1, 2
), grid AS (
  SELECT source_name, unnest(generate_series(min(mi), max(mi), INTERVAL 1 MINUTE)) AS snapshot_minute
  FROM per_min GROUP BY source_name
), snap AS (
  SELECT g.source_name, g.snapshot_minute,
    sum(coalesce(p.n, 0)) OVER (PARTITION BY g.source_name ORDER BY g.snapshot_minute
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hw
  FROM grid g LEFT JOIN per_min p ON g.source_name = p.source_name AND g.snapshot_minute = p.mi
)
SELECT source_name, snapshot_minute, CAST(hw AS BIGINT) AS high_watermark,
  CAST(hw - coalesce(lag(hw) OVER (PARTITION BY source_name ORDER BY snapshot_minute), 0) AS BIGINT) AS new_offsets,
  hw > coalesce(lag(hw) OVER (PARTITION BY source_name ORDER BY snapshot_minute), -1) AS is_active
FROM snap"""
    q["ingest_lag"] = _with(FIXTURE, ARR) + f"""
, l AS (
  SELECT source_name, event_time, epoch_us(kafka_ingest_time) - epoch_us(event_time) AS lag_us
  FROM arr WHERE event_time IS NOT NULL
)
SELECT source_name, time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start,
  time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE AS window_end, count(*) AS records,
  {_r("avg(lag_us) / 1e6", "avg_lag_seconds")}, {_r("max(lag_us) / 1e6", "max_lag_seconds")},
  {_r("min(lag_us) / 1e6", "min_lag_seconds")},
  {_r("quantile_cont(floor(lag_us / 1000000), 0.95)", "p95_lag_seconds")}
FROM l GROUP BY 1, 2, 3"""
    q["late_rows"] = _with(FIXTURE, ARR) + """
, t AS (
  SELECT source_name, event_time,
    max(event_time) OVER (PARTITION BY source_name ORDER BY kafka_ingest_time, kafka_partition, kafka_offset
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_max
  FROM arr WHERE event_time IS NOT NULL
)
SELECT source_name, count(*) AS rows_checked,
  CAST(sum(CASE WHEN event_time < before_max - INTERVAL 20 MINUTE THEN 1 ELSE 0 END) AS BIGINT) AS late_rows
FROM t GROUP BY source_name"""
    # The live streaming path computes exact distincts from bronze and must equal the batch tables.
    q["kpis_stream_live"] = q["realtime_kpis"]
    q["campaign_stream_live"] = q["campaign_sliding"]
    q["drift_stream_live"] = q["channel_drift"]
    # ids sent again change no deduplicated table, but the quality metrics of bronze see their rows
    q["dedup_stream_forever"] = f"SELECT event_id, event_time, session_id, user_id, channel_normalized FROM ({q['dedup_clicks']})"
    q["session_rollup"] = _with(FIXTURE, SILVER) + """
, h AS (SELECT date_trunc('hour', event_time) AS window_start, channel, session_id, CASE WHEN order_status = 'captured' THEN session_id END AS buyer FROM silver)
SELECT window_start, channel, count(*) AS events_total, count(DISTINCT session_id) AS sessions, count(DISTINCT buyer) AS buying, TRUE AS sessions_close, TRUE AS buying_close FROM h GROUP BY 1, 2
UNION ALL
SELECT window_start, '(all)', count(*), count(DISTINCT session_id), count(DISTINCT buyer), TRUE, TRUE FROM h GROUP BY 1"""
    q["lag_rollup"] = _with(FIXTURE, ARR) + f"""
SELECT source_name, date_trunc('hour', event_time) AS window_start, count(*) AS records,
  {_r("max(epoch_us(kafka_ingest_time) - epoch_us(event_time)) / 1e6", "max_lag_seconds")}, TRUE AS p95_close
FROM arr WHERE event_time IS NOT NULL GROUP BY 1, 2"""
    q["alerts_stream_live"] = resent(q["quality_alerts"])
    q["last_touch_stream_live"] = q["attribution_last_touch"]
    # HLL counts differ from engine to engine: the Spark side compares them with its exact counts, which are compared here.
    q["approx_sessions"] = sv + """
SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start, time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE AS window_end,
  channel, count(*) AS events_total, count(DISTINCT session_id) AS sessions, count(DISTINCT order_id) AS orders,
  TRUE AS sessions_close, TRUE AS orders_close
FROM silver GROUP BY 1, 2, 3"""
    q["kpis_stream_append"] = sv + f"""
SELECT window_start, window_end, channel, device_type, country_code, events_total, cart_adds, {_r("gross_revenue", "gross_revenue")},
  {_r("avg_session_intent", "avg_session_intent")}, TRUE AS sessions_close, TRUE AS orders_close FROM kpis"""
    return q
