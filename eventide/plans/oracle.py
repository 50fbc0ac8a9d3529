"""DuckDB statements equal to the registered queries (the correctness oracle).

Tables ``events`` etc. are views over the same parquet files. The shared CTEs
rebuild the adapter, the fault-injected raw lane and the validation checks in
plain SQL; every statement is written independently of the Spark code.
"""

from __future__ import annotations

from . import params as P

EV = """ev AS (
  SELECT event_id, 'user_' || CAST(user_id AS VARCHAR) AS user_id,
         'product_' || json_extract_string(props, '$.k') AS product_id,
         ['electronics','books','clothing','home','sports'][CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 + 1] AS category,
         event_type, epoch_us(ts) // 1000 AS timestamp_ms, event_id % 10 = 0 AS is_late, value
  FROM events)"""

RAW = """raw AS (
  SELECT event_id,
    CASE WHEN event_id % 101 = 1 THEN '' WHEN event_id % 101 = 10 THEN NULL ELSE user_id END AS user_id,
    CASE WHEN event_id % 101 = 2 THEN NULL ELSE product_id END AS product_id,
    CASE WHEN event_id % 101 = 14 THEN NULL ELSE category END AS category,
    CASE WHEN event_id % 101 = 9 THEN NULL WHEN event_id % 101 = 10 THEN ''
         WHEN event_id % 101 = 13 THEN 'user_id_x' ELSE event_type END AS event_type,
    CASE event_id % 101 WHEN 3 THEN '0' WHEN 4 THEN '4102444800001'
         WHEN 5 THEN '-' || CAST(timestamp_ms AS VARCHAR) WHEN 6 THEN 'abc'
         WHEN 7 THEN CAST(timestamp_ms AS VARCHAR) || '.5'
         WHEN 8 THEN ' ' || CAST(timestamp_ms AS VARCHAR) || ' '
         WHEN 11 THEN '4102444800000' WHEN 12 THEN '1e3'
         ELSE CAST(timestamp_ms AS VARCHAR) END AS timestamp_ms,
    is_late, value
  FROM ev)"""

CHK = """chk0 AS (
  SELECT *, coalesce(regexp_matches(timestamp_ms, '^[ ]*[+-]?[0-9]+[ ]*$'), false) AS ts_int
  FROM raw),
chk AS (
  SELECT *, CASE WHEN ts_int THEN TRY_CAST(trim(timestamp_ms) AS BIGINT) END AS ts_val,
    (user_id IS NULL OR user_id = '') AS m_user,
    (product_id IS NULL OR product_id = '') AS m_product,
    (event_type IS NULL OR event_type = '') AS m_type,
    (timestamp_ms IS NULL OR timestamp_ms = ''
     OR coalesce(CASE WHEN ts_int THEN TRY_CAST(trim(timestamp_ms) AS BIGINT) END = 0, false)) AS m_ts
  FROM chk0),
verr AS (
  SELECT event_id, user_id, 'user_id' AS field, user_id AS value,
         'Missing required field: user_id' AS validation_rule, ts_val AS timestamp, 1 AS rule_no FROM chk WHERE m_user
  UNION ALL SELECT event_id, user_id, 'product_id', product_id,
         'Missing required field: product_id', ts_val, 2 FROM chk WHERE m_product
  UNION ALL SELECT event_id, user_id, 'event_type', event_type,
         'Missing required field: event_type', ts_val, 3 FROM chk WHERE m_type
  UNION ALL SELECT event_id, user_id, 'timestamp_ms', timestamp_ms,
         'Missing required field: timestamp_ms', ts_val, 4 FROM chk WHERE m_ts
  UNION ALL SELECT event_id, user_id, 'timestamp_ms', timestamp_ms,
         'Timestamp must be integer: ' || timestamp_ms, ts_val, 5 FROM chk WHERE NOT m_ts AND NOT ts_int
  UNION ALL SELECT event_id, user_id, 'timestamp_ms', timestamp_ms,
         'Invalid timestamp: ' || timestamp_ms, ts_val, 6 FROM chk
         WHERE NOT m_ts AND ts_int AND (ts_val IS NULL OR ts_val < 0 OR ts_val > 4102444800000)
  UNION ALL SELECT event_id, user_id, 'event_type', event_type,
         'Invalid event_type: ' || event_type, ts_val, 7 FROM chk
         WHERE NOT m_type AND event_type NOT IN ('view','click','add_to_cart','purchase')),
valid AS (
  SELECT event_id, user_id, product_id, category, event_type, ts_val AS timestamp_ms, is_late, value
  FROM chk ANTI JOIN verr USING (event_id))"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


VALIDATED = w(EV, RAW, CHK)


def hist_cte(src: str, as_of: int, limit: int, name: str = "hist") -> str:
    """Stored history at ``as_of``: newest ``limit``, current run, not expired."""
    return f"""{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp_ms DESC, event_id DESC) AS pos
  FROM {src} WHERE timestamp_ms <= {as_of}),
{name}_t AS (
  SELECT *, lead(timestamp_ms) OVER (PARTITION BY user_id ORDER BY timestamp_ms DESC, event_id DESC) AS older,
         max(timestamp_ms) OVER (PARTITION BY user_id) AS newest
  FROM {name}_r WHERE pos <= {limit}),
{name}_c AS (
  SELECT *, min(CASE WHEN older IS NULL OR timestamp_ms - older >= 86400000 THEN pos END)
            OVER (PARTITION BY user_id) AS cut
  FROM {name}_t),
{name} AS (SELECT * FROM {name}_c WHERE pos <= cut AND {as_of} - newest < 86400000)"""


def feats_cte(src: str, as_of: int, name: str = "feats") -> str:
    return f"""{name} AS (
  SELECT user_id,
    CAST(count(*) AS DOUBLE) / count(DISTINCT coalesce(category, '<null>')) AS avg_time_category,
    CAST(count(*) FILTER (WHERE event_type IN ('click','view')) AS DOUBLE) AS click_count,
    CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS purchase_count,
    ({as_of} - max(timestamp_ms)) / 60000.0 AS recency
  FROM {src} GROUP BY user_id)"""


def score_sql(a="avg_time_category", c="click_count", p="purchase_count", r="recency") -> str:
    return (f"1.0 / (1.0 + exp(-(-1.0 + 0.02 * {a} + 0.05 * {c} + 0.4 * {p} - 0.0005 * {r})))")


ORACLE: dict[str, str] = {}

ORACLE["user_scores"] = w(EV, RAW, CHK, f"upto AS (SELECT * FROM valid WHERE timestamp_ms <= {P.AS_OF_MS})",
                          hist_cte("upto", P.AS_OF_MS, P.CHECK_LIMIT), feats_cte("hist", P.AS_OF_MS),
                          """j AS (
  SELECT u.user_id, f.avg_time_category IS NOT NULL AS has_history,
    coalesce(f.avg_time_category, 0.0) AS avg_time_category, coalesce(f.click_count, 0.0) AS click_count,
    coalesce(f.purchase_count, 0.0) AS purchase_count, coalesce(f.recency, 1440.0) AS recency
  FROM (SELECT DISTINCT user_id FROM upto) u LEFT JOIN feats f USING (user_id))""") + f"""
SELECT user_id, has_history, round(avg_time_category, 6) AS avg_time_category,
  round(click_count, 6) AS click_count, round(purchase_count, 6) AS purchase_count,
  round(recency, 6) AS recency, round({score_sql()}, 6) AS prediction FROM j"""

ORACLE["src_events"] = w(EV) + """
SELECT event_id, user_id, product_id, category, event_type, timestamp_ms, is_late FROM ev"""

ORACLE["map_pair"] = w(EV) + "SELECT event_id, user_id, CAST(1 AS BIGINT) AS one FROM ev"

ORACLE["event_time"] = w(EV) + """
SELECT event_id, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS event_time,
  CAST(floor(timestamp_ms / 1000) * 1000 AS BIGINT) AS event_time_sec_ms FROM ev"""

ORACLE["type_flags"] = w(EV) + """
SELECT event_id, event_type IN ('click','view') AS is_click, event_type = 'purchase' AS is_purchase,
  event_type = 'add_to_cart' AS is_cart FROM ev"""

ORACLE["validate"] = VALIDATED + """
SELECT c.event_id, CAST(count(v.rule_no) AS BIGINT) AS n_errors,
  coalesce(string_agg(v.validation_rule, ' | ' ORDER BY v.rule_no), '') AS messages
FROM chk c LEFT JOIN verr v USING (event_id) GROUP BY c.event_id"""

ORACLE["validation_errors"] = VALIDATED + """
SELECT event_id, user_id, field, value, validation_rule, timestamp, CAST(rule_no AS BIGINT) AS rule_no FROM verr"""

ORACLE["error_field"] = VALIDATED + """
SELECT event_id, validation_rule, field,
  CASE WHEN contains(validation_rule, 'user_id') THEN 'user_id'
       WHEN contains(validation_rule, 'product_id') THEN 'product_id'
       WHEN contains(validation_rule, 'event_type') THEN 'event_type'
       WHEN contains(validation_rule, 'timestamp') THEN 'timestamp_ms' ELSE 'unknown' END AS field_parity
FROM verr"""

ORACLE["valid_only"] = VALIDATED + """
SELECT event_id, user_id, product_id, category, event_type, timestamp_ms FROM valid"""

ORACLE["key_format"] = """
SELECT event_id, 'user_' || CAST(user_id AS VARCHAR) AS user_key,
  'product_' || json_extract_string(props, '$.k') AS product_key,
  'user_' || CAST(event_id % 50 AS VARCHAR) AS bench_user FROM events"""

ORACLE["iso_time"] = w(EV) + """
SELECT event_id, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S.%g') AS iso,
  epoch_us(strptime(strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S.%g'),
                    '%Y-%m-%dT%H:%M:%S.%g')) // 1000 = timestamp_ms AS round_trip FROM ev"""

ORACLE["running_count"] = w(EV) + """
SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_count FROM ev"""

ORACLE["user_counts"] = w(EV) + "SELECT user_id, count(*) AS event_count FROM ev GROUP BY user_id"

ORACLE["category_counts"] = w(EV) + """
SELECT user_id, category, count(*) AS n_events FROM ev GROUP BY user_id, category"""

ORACLE["user_features"] = w(EV, hist_cte("ev", P.AS_OF_MS, P.CHECK_LIMIT), feats_cte("hist", P.AS_OF_MS)) + """
SELECT user_id, round(avg_time_category, 6) AS avg_time_category, round(click_count, 6) AS click_count,
  round(purchase_count, 6) AS purchase_count, round(recency, 6) AS recency FROM feats"""

ORACLE["last_100"] = w(EV) + f"""
SELECT user_id, event_id, pos FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY timestamp_ms DESC, event_id DESC) AS pos
  FROM ev) WHERE pos <= {P.CHECK_LIMIT}"""

ORACLE["history_ttl"] = w(EV, hist_cte("ev", P.AS_OF_MS, 10**9)) + "SELECT user_id, event_id FROM hist"

ORACLE["features_online"] = w(EV, """s0 AS (
  SELECT *, lag(timestamp_ms) OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id) AS prev FROM ev)""",
  """s1 AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR timestamp_ms - prev >= 86400000 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS hist_session FROM s0)""") + f"""
SELECT event_id, user_id, CAST(hist_session AS BIGINT) AS hist_session,
  round((timestamp_ms - prev) / 60000.0, 6) AS gap_minutes,
  round(CAST(count(*) OVER w AS DOUBLE) / length(list_distinct(list(coalesce(category, '<null>')) OVER w)), 6)
    AS avg_time_category,
  round(CAST(count(*) FILTER (WHERE event_type IN ('click','view')) OVER w AS DOUBLE), 6) AS click_count,
  round(CAST(count(*) FILTER (WHERE event_type = 'purchase') OVER w AS DOUBLE), 6) AS purchase_count,
  round((timestamp_ms - max(timestamp_ms) OVER w) / 60000.0, 6) AS recency
FROM s1
WINDOW w AS (PARTITION BY user_id, hist_session ORDER BY timestamp_ms, event_id
             ROWS BETWEEN {P.CHECK_LIMIT - 1} PRECEDING AND CURRENT ROW)"""


def online_cte(src: str, limit: int, name: str = "onl") -> str:
    """Features every event sees over its last ``limit`` events of the current history."""
    return f"""{name}_s0 AS (
  SELECT *, lag(timestamp_ms) OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id) AS prev FROM {src}),
{name}_s1 AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR timestamp_ms - prev >= 86400000 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS hist_session FROM {name}_s0),
{name} AS (
  SELECT *, (timestamp_ms - prev) / 60000.0 AS gap_minutes,
    CAST(count(*) OVER w AS DOUBLE) / length(list_distinct(list(coalesce(category, '<null>')) OVER w))
      AS avg_time_category,
    CAST(count(*) FILTER (WHERE event_type IN ('click','view')) OVER w AS DOUBLE) AS click_count,
    CAST(count(*) FILTER (WHERE event_type = 'purchase') OVER w AS DOUBLE) AS purchase_count,
    coalesce((timestamp_ms - prev) / 60000.0, 1440.0) AS recency
  FROM {name}_s1
  WINDOW w AS (PARTITION BY user_id, hist_session ORDER BY timestamp_ms, event_id
               ROWS BETWEEN {limit - 1} PRECEDING AND CURRENT ROW))"""


FAILS = """(value >= 200.0 OR (user_id LIKE '%7' AND timestamp_ms >= 1704844800000 AND timestamp_ms < 1705276800000))"""


def retry_cte(src: str, failed: str, name: str = "rt") -> str:
    return f"""{name}_0 AS (
  SELECT *, {failed} AS failed,
    row_number() OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id) AS rn FROM {src}),
{name}_1 AS (
  SELECT *, rn - coalesce(max(CASE WHEN NOT failed THEN rn END) OVER (PARTITION BY user_id
    ORDER BY timestamp_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS k FROM {name}_0),
{name}_2 AS (SELECT *, CASE WHEN failed THEN ((k - 1) % 4) + 1 END AS retry_count FROM {name}_1),
{name} AS (
  SELECT *, CASE WHEN NOT failed THEN 'success' WHEN retry_count <= 3 THEN 'retry' ELSE 'dlq' END AS route,
    CASE WHEN failed AND retry_count <= 3 THEN CAST(1000 * pow(2, retry_count - 1) AS BIGINT) END AS delay_ms
  FROM {name}_2)"""


def cache_cte(src: str, ttl: int, name: str = "cache") -> str:
    return f"""{name}_o AS (
  SELECT user_id, event_id, timestamp_ms,
    row_number() OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id) AS rn FROM {src}),
{name} AS (
  SELECT user_id, rn, event_id, timestamp_ms, timestamp_ms AS anchor, false AS hit FROM {name}_o WHERE rn = 1
  UNION ALL
  SELECT o.user_id, o.rn, o.event_id, o.timestamp_ms,
    CASE WHEN o.timestamp_ms - c.anchor < {ttl} THEN c.anchor ELSE o.timestamp_ms END,
    o.timestamp_ms - c.anchor < {ttl}
  FROM {name} c JOIN {name}_o o ON o.user_id = c.user_id AND o.rn = c.rn + 1)"""


ORACLE["features_online"] = w(EV, online_cte("ev", P.CHECK_LIMIT)) + """
SELECT event_id, user_id, CAST(hist_session AS BIGINT) AS hist_session, round(gap_minutes, 6) AS gap_minutes,
  round(avg_time_category, 6) AS avg_time_category, round(click_count, 6) AS click_count,
  round(purchase_count, 6) AS purchase_count, round(recency, 6) AS recency FROM onl"""

ORACLE["retry_route"] = w(EV, retry_cte("ev", "event_type = 'error'")) + """
SELECT event_id, user_id, failed, CAST(retry_count AS BIGINT) AS retry_count, route FROM rt"""

ORACLE["retry_backoff"] = w(EV, retry_cte("ev", "event_type = 'error'")) + """
SELECT event_id, CAST(retry_count AS BIGINT) AS retry_count, delay_ms, timestamp_ms + delay_ms AS retry_at_ms
FROM rt WHERE route = 'retry'"""

_EVENT_JSON = ("json_object('user_id', user_id, 'product_id', product_id, 'category', category, "
               "'event_type', event_type, 'timestamp_ms', timestamp_ms)::VARCHAR")

ORACLE["sink_fanout"] = w(EV, RAW, CHK, retry_cte("valid", FAILS)) + f"""
SELECT 'success' AS lane, event_id, user_id, 'SUCCESS' AS detail FROM rt WHERE route = 'success'
UNION ALL SELECT 'validation_errors', event_id, user_id, validation_rule FROM verr
UNION ALL SELECT 'dlq', event_id, user_id,
  'ScoringError model input out of range for ' || product_id || ' ' || {_EVENT_JSON} FROM rt WHERE route = 'dlq'
UNION ALL SELECT 'retry', event_id, user_id, CAST(retry_count AS VARCHAR) FROM rt WHERE route = 'retry'"""

ORACLE["event_json"] = w(EV, RAW) + f"SELECT event_id, {_EVENT_JSON} AS original_event FROM raw"

ORACLE["error_trunc"] = VALIDATED + f"""
SELECT v.event_id, CAST(v.rule_no AS BIGINT) AS rule_no,
  substring(v.validation_rule || ' in ' || {_EVENT_JSON.replace('user_id,', 'c.user_id,').replace("'timestamp_ms', timestamp_ms", "'timestamp_ms', c.timestamp_ms")}, 1, 100) AS error
FROM verr v JOIN chk c USING (event_id)"""

ORACLE["feature_asof"] = w(EV, online_cte("ev", P.CHECK_LIMIT)) + f"""
SELECT event_id, user_id, product_id, round({score_sql()}, 6) AS prediction, timestamp_ms AS event_time,
  timestamp_ms + CAST(trunc(value * 10) AS BIGINT) % 100 AS processing_time FROM onl"""

ORACLE["score_fallback"] = w(EV, online_cte("ev", P.CHECK_LIMIT)) + f"""
SELECT event_id, CASE WHEN value >= 200.0 THEN 0.5 ELSE round({score_sql()}, 6) END AS prediction,
  value >= 200.0 AS fallback, CASE WHEN value >= 200.0 THEN 'scoring failed' END AS error FROM onl"""

_TAKEN = "timestamp_ms + CAST(trunc(value * 10) AS BIGINT) % 100"
_LANES = (EV, RAW, CHK, online_cte("valid", P.CHECK_LIMIT), retry_cte("onl", FAILS))

ORACLE["score_success"] = w(*_LANES) + f"""
SELECT event_id, user_id, product_id, round({score_sql()}, 6) AS prediction, timestamp_ms AS event_time, {_TAKEN} AS processing_time,
  'SUCCESS' AS status FROM rt WHERE route = 'success'"""

ORACLE["event_lanes"] = w(*_LANES) + f"""
SELECT 'success' AS lane, event_id, user_id, product_id, round({score_sql()}, 6) AS prediction, timestamp_ms AS event_time,
  {_TAKEN} AS processing_time, 'SUCCESS' AS status, NULL AS field, NULL AS bad_value, NULL AS validation_rule, NULL AS original_event,
  NULL AS error_message, NULL AS error_type, CAST(NULL AS BIGINT) AS retry_count, CAST(NULL AS BIGINT) AS retry_at_ms
  FROM rt WHERE route = 'success'
UNION ALL SELECT 'validation_errors', event_id, user_id, NULL, NULL, timestamp, NULL, NULL, field, value, validation_rule, NULL, NULL,
  NULL, NULL, NULL FROM verr
UNION ALL SELECT 'dlq', event_id, user_id, NULL, NULL, timestamp_ms, NULL, NULL, NULL, NULL, NULL, {_EVENT_JSON},
  'model input out of range for ' || product_id, 'ScoringError', retry_count, NULL FROM rt WHERE route = 'dlq'
UNION ALL SELECT 'retry', event_id, user_id, NULL, NULL, timestamp_ms, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, retry_count,
  timestamp_ms + delay_ms FROM rt WHERE route = 'retry'"""

ORACLE["infer_batches"] = w(EV, online_cte("ev", P.CHECK_LIMIT)) + f"""
SELECT event_id, round({score_sql()}, 6) AS prediction FROM onl"""

ORACLE["cache_hits"] = "WITH RECURSIVE " + ",\n".join([EV, cache_cte("ev", P.CACHE_TTL_MS)]) + """
SELECT event_id, user_id, hit AS cache_hit FROM cache"""

ORACLE["cache_evict"] = "WITH RECURSIVE " + ",\n".join([EV, cache_cte("ev", P.CACHE_TTL_MS)]) + f"""
SELECT user_id, max(timestamp_ms) AS cached_at_ms FROM cache WHERE NOT hit GROUP BY user_id
ORDER BY cached_at_ms DESC, user_id LIMIT {P.CACHE_CAP}"""

# one step an event of a worker: the cache is a list of entries, oldest written first
_BOUNDED = "WITH RECURSIVE " + ",\n".join([EV, online_cte("ev", P.CHECK_LIMIT), f"""e AS MATERIALIZED (
  SELECT event_id, user_id, product_id, timestamp_ms AS t, CAST(trunc(value * 10) AS BIGINT) % 100 AS took, {score_sql()} AS s,
    ({FAILS}) AS fails, CAST('0x' || substring(md5(user_id), 1, 8) AS BIGINT) % {P.CACHE_SHARDS} AS shard FROM onl)""",
    """n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY t, event_id) AS rn FROM e)""",
    f"""c AS (SELECT DISTINCT shard, CAST(0 AS BIGINT) AS rn, CAST([] AS STRUCT(u VARCHAR, t BIGINT, s DOUBLE)[]) AS cache,
    CAST(NULL AS BIGINT) AS event_id, false AS hit, CAST(NULL AS DOUBLE) AS prediction FROM n
  UNION ALL
  SELECT shard, rn, CASE WHEN held IS NOT NULL THEN cache WHEN fails THEN rest
      ELSE list_append(CASE WHEN len(rest) >= {P.CACHE_CAP} THEN rest[2:] ELSE rest END, {{'u': user_id, 't': t, 's': s}}) END,
    event_id, held IS NOT NULL, CASE WHEN held IS NOT NULL THEN held.s WHEN fails THEN 0.5 ELSE s END
  FROM (SELECT n.*, cache, [x FOR x IN cache IF x.u = n.user_id AND n.t - x.t < {P.CACHE_TTL_MS}][1] AS held,
      [x FOR x IN cache IF x.u <> n.user_id] AS rest
    FROM c JOIN n ON n.shard = c.shard AND n.rn = c.rn + 1))"""])

ORACLE["optimized_predictions"] = _BOUNDED + """
SELECT event_id, user_id, product_id, round(prediction, 6) AS prediction, t AS event_time, t + took AS processing_time,
  CASE WHEN hit THEN 0 WHEN fails THEN -1 ELSE took END AS latency_ms, hit AS cache_hit,
  CASE WHEN NOT hit AND fails THEN 'scoring failed' END AS error FROM c JOIN n USING (shard, rn, event_id)"""

ORACLE["cache_contents"] = _BOUNDED + """, z AS (SELECT shard, max_by(cache, rn) AS cache FROM c GROUP BY shard)
SELECT shard, cache[i].u AS user_id, cache[i].t AS cached_at_ms, i - 1 AS place, round(cache[i].s, 6) AS prediction
FROM z, unnest(range(1, len(cache) + 1)) AS r(i)"""

ORACLE["recs_recall"] = w(EV) + "SELECT count(DISTINCT user_id) AS n_users, true AS recall_ok FROM ev WHERE product_id IS NOT NULL"

ORACLE["latency_sketch"] = w(EV) + """SELECT event_type, CAST(q AS DOUBLE) AS q, true AS within
FROM (SELECT DISTINCT event_type FROM ev WHERE event_id % 97 <> 0), (VALUES (0.5), (0.95), (0.99)) AS t(q)"""

ORACLE["split"] = w(EV) + """
SELECT CASE WHEN CAST('0x' || substring(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split,
  count(*) AS n FROM ev GROUP BY 1"""

# one step an event of a worker: the users of the open batch and its number
ORACLE["infer_user_batches"] = "WITH RECURSIVE " + ",\n".join([EV, f"""n AS MATERIALIZED (
  SELECT event_id, user_id, shard, row_number() OVER (PARTITION BY shard ORDER BY timestamp_ms, event_id) AS rn
  FROM (SELECT *, CAST('0x' || substring(md5(user_id), 1, 8) AS BIGINT) % {P.CACHE_SHARDS} AS shard FROM ev))""",
    f"""b AS (SELECT DISTINCT shard, CAST(0 AS BIGINT) AS rn, CAST([] AS VARCHAR[]) AS users, CAST(0 AS BIGINT) AS batch,
    CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS user_id, CAST(0 AS BIGINT) AS upto FROM n
  UNION ALL
  SELECT n.shard, n.rn, CASE WHEN len(now) = {P.BATCH_USERS} THEN CAST([] AS VARCHAR[]) ELSE now END, upto, n.event_id, n.user_id,
    CASE WHEN len(now) = {P.BATCH_USERS} THEN upto + 1 ELSE upto END
  FROM (SELECT n.*, upto, CASE WHEN list_contains(users, n.user_id) THEN users ELSE list_append(users, n.user_id) END AS now
    FROM b JOIN n ON n.shard = b.shard AND n.rn = b.rn + 1) AS n)"""]) + """
SELECT shard, batch, user_id, arg_min(event_id, rn) AS event_id, count(*) AS n_events, true AS same FROM b WHERE rn > 0
GROUP BY shard, batch, user_id"""

ORACLE["pred_union"] = w(EV, online_cte("ev", P.CHECK_LIMIT), f"upto AS (SELECT * FROM ev WHERE timestamp_ms <= {P.AS_OF_MS})",
                         hist_cte("upto", P.AS_OF_MS, P.CHECK_LIMIT), feats_cte("hist", P.AS_OF_MS),
                         """j AS (
  SELECT u.user_id, coalesce(f.avg_time_category, 0.0) AS avg_time_category, coalesce(f.click_count, 0.0) AS click_count,
    coalesce(f.purchase_count, 0.0) AS purchase_count, coalesce(f.recency, 1440.0) AS recency
  FROM (SELECT DISTINCT user_id FROM upto) u LEFT JOIN feats f USING (user_id))""") + f"""
SELECT user_id, product_id, round({score_sql()}, 6) AS prediction, timestamp_ms AS event_time,
  false AS batch_processed FROM onl
UNION ALL
SELECT user_id, NULL, round({score_sql()}, 6), NULL, true FROM j"""


MON = """mon AS (
  SELECT *, timestamp_ms + CASE WHEN is_late THEN (300 + (event_id * 37) % 301) * 1000 ELSE 0 END AS arrival_ms,
    timestamp_ms + CAST(trunc(value * 10) AS BIGINT) % 100 AS processing_time,
    CASE WHEN event_id % 10 <= 5 THEN 'normal_load' WHEN event_id % 10 <= 8 THEN 'peak_load' ELSE 'late_data' END
      AS load_scenario
  FROM ev),
mon2 AS (
  SELECT *, processing_time - timestamp_ms AS latency_ms, arrival_ms - timestamp_ms > 300000 AS is_late_arrival
  FROM mon),
rec AS (SELECT * FROM mon2 WHERE event_id % 97 <> 0)"""

ORACLE["tumble"] = w(EV) + """
SELECT user_id, timestamp_ms - timestamp_ms % 60000 AS window_start_ms, timestamp_ms - timestamp_ms % 60000 + 60000 AS window_end_ms,
  count(*) AS n_events FROM ev GROUP BY ALL"""

ORACLE["session_events"] = w(EV) + """
SELECT user_id, timestamp_ms - timestamp_ms % 60000 AS window_start_ms, timestamp_ms - timestamp_ms % 60000 + 60000 AS window_end_ms,
  string_agg(category || ':' || event_type, ',' ORDER BY timestamp_ms, event_id) AS items FROM ev GROUP BY ALL"""

ORACLE["sessions"] = w(EV, """s AS (
  SELECT *, lag(timestamp_ms) OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id) AS prev FROM ev)""",
                       """s2 AS (SELECT *, sum(CASE WHEN prev IS NULL OR timestamp_ms - prev > """ + str(P.SESSION_GAP_MS) + """ THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn FROM s)""") + f"""
SELECT user_id, min(timestamp_ms) AS session_start_ms, max(timestamp_ms) + {P.SESSION_GAP_MS} AS session_end_ms,
  count(*) AS n_events FROM s2 GROUP BY user_id, sn"""

ORACLE["late_split"] = w(EV, MON, """m AS (
  SELECT *, max(timestamp_ms) OVER (ORDER BY arrival_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM mon2)""") + f"""
SELECT event_id, CASE WHEN seen IS NULL OR timestamp_ms >= seen - {P.LATE_LANE_MS} THEN 'on_time'
  WHEN timestamp_ms >= seen - {P.LATE_LANE_MS + P.ALLOWED_LATENESS_MS} THEN 'allowed' ELSE 'too_late' END AS lane,
  seen - {P.LATE_LANE_MS} AS watermark_ms FROM m"""

ORACLE["count_window"] = w(EV, MON, """g AS (
  SELECT *, row_number() OVER (ORDER BY arrival_ms, event_id) - 1 AS gidx FROM mon2)""") + """
SELECT CAST(gidx // 100 AS BIGINT) AS chunk, count(*) AS n, min(event_id) AS first_event_id,
  max(event_id) AS last_event_id, count(*) FILTER (WHERE is_late_arrival) AS n_late FROM g GROUP BY 1"""

ORACLE["dedup_events"] = w(EV, MON, """dup AS (
  SELECT * FROM mon2 UNION ALL SELECT * REPLACE (arrival_ms + 90000 AS arrival_ms) FROM mon2 WHERE event_id % 7 = 0)""",
                           """once AS (SELECT * FROM dup QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival_ms) = 1)""") + """
SELECT user_id, count(*) AS n_events, max(arrival_ms) AS last_arrival_ms FROM once GROUP BY user_id"""

ORACLE["latency_ms"] = w(EV, MON) + "SELECT event_id, latency_ms FROM mon2"

ORACLE["is_late"] = w(EV, MON) + "SELECT event_id, arrival_ms - timestamp_ms AS delay_ms, is_late_arrival AS is_late FROM mon2"

ORACLE["latency_band"] = w(EV, MON) + """
SELECT event_type, CASE WHEN latency_ms > 30 THEN 'high' WHEN latency_ms > 15 THEN 'medium' ELSE 'low' END AS band,
  count(*) AS n FROM mon2 GROUP BY ALL"""

ORACLE["latency_components"] = w(EV, MON, """c AS (
  SELECT 'delivery' AS component, arrival_ms - timestamp_ms AS v FROM mon2
  UNION ALL SELECT 'processing', latency_ms FROM mon2
  UNION ALL SELECT 'end_to_end', arrival_ms - timestamp_ms + latency_ms FROM mon2)""",
    """p AS (SELECT component, count(v) AS n, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.95), 6) AS p95 FROM c GROUP BY component)""") + """
SELECT *, CASE WHEN p95 > 30 THEN 'high' WHEN p95 > 15 THEN 'medium' ELSE 'low' END AS band,
  component <> 'end_to_end' AND p95 > 15 AND p95 = max(CASE WHEN component <> 'end_to_end' THEN p95 END) OVER () AS offender FROM p"""

ORACLE["late_rate"] = w(EV, MON) + f"""
SELECT timestamp_ms - timestamp_ms % {P.HOUR_MS} AS window_start_ms, count(*) AS n,
  count(*) FILTER (WHERE is_late_arrival) AS n_late,
  round(count(*) FILTER (WHERE is_late_arrival) * 100.0 / count(*), 6) AS late_rate FROM mon2 GROUP BY 1"""

_LAT = """count(latency_ms) AS n, round(avg(latency_ms), 6) AS mean, round(quantile_cont(latency_ms, 0.5), 6) AS p50,
  round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99,
  round(CAST(min(latency_ms) AS DOUBLE), 6) AS min, round(CAST(max(latency_ms) AS DOUBLE), 6) AS max"""

ORACLE["latency_stats"] = w(EV, MON) + f"SELECT event_type, {_LAT} FROM rec GROUP BY event_type"

ORACLE["latency_sla"] = w(EV, MON) + """
SELECT load_scenario, count(*) FILTER (WHERE latency_ms > 0) AS n_positive,
  round(quantile_cont(latency_ms, 0.95) FILTER (WHERE latency_ms > 0), 6) AS p95,
  CASE WHEN count(*) FILTER (WHERE latency_ms > 0) > 0
       THEN quantile_cont(latency_ms, 0.95) FILTER (WHERE latency_ms > 0) < 75 END AS sla_pass
FROM rec GROUP BY load_scenario"""

_SAMPLE = f"smp AS (SELECT * FROM rec ORDER BY event_id LIMIT {P.SAMPLE_N})"

ORACLE["sample_first_n"] = w(EV, MON, _SAMPLE) + "SELECT event_id, user_id, is_late FROM smp"

ORACLE["late_check"] = w(EV, MON) + """
SELECT count(*) AS n, count(*) FILTER (WHERE is_late) AS n_late,
  round(count(*) FILTER (WHERE is_late) / count(*), 6) AS late_share,
  CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE is_late) > 0 END AS passed FROM rec"""

_LOSS = """loss AS (
  SELECT count(*) AS sent, (SELECT count(DISTINCT event_id) FROM rec) AS received,
    count(*) FILTER (WHERE event_id NOT IN (SELECT event_id FROM rec)) AS lost FROM mon2)"""

ORACLE["data_loss"] = w(EV, MON, _LOSS) + """
SELECT sent, received, lost, round((sent - received) * 100.0 / sent, 6) AS loss_pct,
  (sent - received) * 100.0 / sent <= 1.0 AS passed FROM loss"""

ORACLE["verdict"] = w(EV, MON, _LOSS, """c AS (
  SELECT (SELECT CASE WHEN count(*) FILTER (WHERE latency_ms > 0) > 0
            THEN quantile_cont(latency_ms, 0.95) FILTER (WHERE latency_ms > 0) < 75 END FROM rec) AS latency_ok,
         (SELECT CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE is_late) > 0 END FROM rec) AS late_ok,
         (SELECT (sent - received) * 100.0 / sent <= 1.0 FROM loss) AS loss_ok)""") + """
SELECT latency_ok, late_ok, loss_ok,
  coalesce(latency_ok, true) AND coalesce(late_ok, true) AND coalesce(loss_ok, true) AS overall FROM c"""

ORACLE["scenario_counts"] = w(EV, MON) + "SELECT load_scenario, count(*) AS n_events FROM mon2 GROUP BY 1"

_PHASE = f"""ph AS (SELECT *, CASE WHEN timestamp_ms < {P.DRIFT_SPLIT_MS} THEN 'before' ELSE 'after' END AS phase
  FROM rec)"""

ORACLE["before_after"] = w(EV, MON, _PHASE, """st AS (
  SELECT phase, avg(latency_ms) AS mean, quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95,
    quantile_cont(latency_ms, 0.99) AS p99, CAST(min(latency_ms) AS DOUBLE) AS min, CAST(max(latency_ms) AS DOUBLE) AS max
  FROM ph WHERE latency_ms > 0 GROUP BY phase)""", """lng AS (
  UNPIVOT st ON p50, p95, p99, mean, min, max INTO NAME statistic VALUE v)""") + """
SELECT statistic, round(max(v) FILTER (WHERE phase = 'before'), 6) AS before,
  round(max(v) FILTER (WHERE phase = 'after'), 6) AS after,
  round(CASE WHEN max(v) FILTER (WHERE phase = 'before') <> 0 THEN
    (max(v) FILTER (WHERE phase = 'before') - max(v) FILTER (WHERE phase = 'after'))
    / max(v) FILTER (WHERE phase = 'before') * 100 END, 6) AS improvement_pct
FROM lng GROUP BY statistic"""

ORACLE["throughput"] = w(EV, MON) + """
SELECT load_scenario, count(*) AS n, round((max(timestamp_ms) - min(timestamp_ms)) / 1000.0, 6) AS elapsed_s,
  round(avg(latency_ms) FILTER (WHERE latency_ms > 0), 6) AS mean_latency_ms,
  round(count(*) / ((max(timestamp_ms) - min(timestamp_ms)) / 1000.0), 6) AS events_per_s,
  round(1000.0 / avg(latency_ms) FILTER (WHERE latency_ms > 0), 6) AS model_rps
FROM mon2 GROUP BY load_scenario"""

ORACLE["latency_hist"] = w(EV, MON, _PHASE, """p AS (SELECT * FROM ph WHERE latency_ms > 0)""",
                           """rng AS (SELECT phase, CAST(min(latency_ms) AS DOUBLE) AS lo, CAST(max(latency_ms) AS DOUBLE) AS hi FROM p GROUP BY phase)""",
                           """cnt AS (
  SELECT p.phase, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((latency_ms - lo) / ((hi - lo) / 30)), 29) END AS BIGINT) AS bin,
    count(*) AS n FROM p JOIN rng USING (phase) GROUP BY ALL)""") + """
SELECT r.phase, CAST(b.bin AS BIGINT) AS bin, round(lo + (hi - lo) / 30 * b.bin, 6) AS bin_lo,
  round(lo + (hi - lo) / 30 * (b.bin + 1), 6) AS bin_hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM rng r CROSS JOIN range(30) b(bin) LEFT JOIN cnt c ON c.phase = r.phase AND c.bin = b.bin"""

ORACLE["dlq_share"] = w(EV, RAW, CHK, retry_cte("valid", FAILS)) + f"""
SELECT e.day_ms, e.n_messages, coalesce(q.n_dlq, 0) AS n_dlq, round(coalesce(q.n_dlq, 0) / e.n_messages, 6) AS dlq_share
FROM (SELECT timestamp_ms - timestamp_ms % {P.DAY_MS} AS day_ms, count(*) AS n_messages FROM ev GROUP BY 1) e
LEFT JOIN (SELECT timestamp_ms - timestamp_ms % {P.DAY_MS} AS day_ms, count(*) AS n_dlq FROM rt WHERE route = 'dlq' GROUP BY 1) q
USING (day_ms)"""

ORACLE["error_counters"] = w(EV, RAW, CHK, retry_cte("valid", FAILS)) + """
SELECT 'validation_errors_total' AS counter, field AS label_a, validation_rule AS label_b, count(*) AS n FROM verr GROUP BY ALL
UNION ALL SELECT 'dlq_messages_total', 'ScoringError', NULL, count(*) FROM rt WHERE route = 'dlq' HAVING count(*) > 0"""


ORACLE["top_items"] = w(EV, """pop AS (SELECT category, product_id, count(*) AS n FROM ev GROUP BY ALL)""") + f"""
SELECT * FROM (SELECT category, row_number() OVER (PARTITION BY category ORDER BY n DESC, product_id) AS rank,
  product_id, n FROM pop) WHERE rank <= {P.TOP_K}"""

ORACLE["cold_start"] = w(EV, f"""bef AS (SELECT * FROM ev WHERE timestamp_ms < {P.COLD_AS_OF_MS})""",
                         f"""aft AS (SELECT * FROM ev WHERE timestamp_ms >= {P.COLD_AS_OF_MS}
  AND user_id NOT IN (SELECT user_id FROM bef))""",
                         """fst AS (SELECT user_id, category FROM aft
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id) = 1)""",
                         """pop AS (SELECT category, product_id, count(*) AS n FROM bef GROUP BY category, product_id)""",
                         f"""top AS (SELECT * FROM (SELECT category, product_id, n,
  row_number() OVER (PARTITION BY category ORDER BY n DESC, product_id) AS rank FROM pop)
  WHERE rank <= {P.TOP_K} UNION ALL SELECT * FROM (SELECT NULL, product_id, count(*) AS n,
  row_number() OVER (ORDER BY count(*) DESC, product_id) AS rank FROM bef GROUP BY product_id) WHERE rank <= {P.TOP_K})""") + """
SELECT f.user_id, f.category, t.rank, t.product_id, t.n FROM fst f
JOIN top t ON CASE WHEN f.category IN (SELECT category FROM pop) THEN f.category END IS NOT DISTINCT FROM t.category"""

ORACLE["ctr"] = w(EV, """g AS (SELECT category, count(*) FILTER (WHERE event_type = 'click') AS clicks,
  count(*) FILTER (WHERE event_type = 'view') AS views FROM ev GROUP BY category)""") + """
SELECT category, clicks, views, round(CASE WHEN views > 0 THEN clicks / views END, 6) AS ctr,
  round(CASE WHEN views > 0 THEN clicks / views END / (sum(clicks) OVER () / sum(views) OVER ()), 6) AS lift FROM g"""


def _feat_sql(where: str, as_of: str, by: str = "") -> str:
    return f"""SELECT {by} user_id,
    CAST(count(*) AS DOUBLE) / count(DISTINCT coalesce(category, '<null>')) AS avg_time_category,
    CAST(count(*) FILTER (WHERE event_type IN ('click','view')) AS DOUBLE) AS click_count,
    CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS purchase_count,
    CAST(({as_of} - max(timestamp_ms)) / 60000.0 AS DOUBLE) AS recency
  FROM ev WHERE {where} GROUP BY ALL"""


DRIFT = [EV,
         f"fr AS ({_feat_sql(f'timestamp_ms < {P.DRIFT_SPLIT_MS}', str(P.DRIFT_SPLIT_MS))})",
         f"fc AS ({_feat_sql(f'timestamp_ms >= {P.DRIFT_SPLIT_MS} AND timestamp_ms <= {P.AS_OF_MS}', str(P.AS_OF_MS))})",
         """rl AS (UNPIVOT fr ON avg_time_category, click_count, purchase_count, recency INTO NAME "column" VALUE value)""",
         """cl AS (UNPIVOT fc ON avg_time_category, click_count, purchase_count, recency INTO NAME "column" VALUE value)""",
         """edges AS (SELECT "column", quantile_cont(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges
  FROM rl GROUP BY 1)""",
         """rb AS (SELECT "column", CAST(len(list_filter(edges, lambda e: e < value)) AS BIGINT) AS bin, count(*) AS n
  FROM rl JOIN edges USING ("column") GROUP BY ALL)""",
         """cb AS (SELECT "column", CAST(len(list_filter(edges, lambda e: e < value)) AS BIGINT) AS bin, count(*) AS n
  FROM cl JOIN edges USING ("column") GROUP BY ALL)""",
         """cdf0 AS (
  SELECT "column", value, coalesce(r.rn, 0) AS rn, coalesce(c.cn, 0) AS cn FROM
  (SELECT "column", value, count(*) AS rn FROM rl GROUP BY ALL) r
  FULL JOIN (SELECT "column", value, count(*) AS cn FROM cl GROUP BY ALL) c USING ("column", value))""",
         """cdf AS (
  SELECT *, sum(rn) OVER (PARTITION BY "column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      / sum(rn) OVER (PARTITION BY "column") AS fr,
    sum(cn) OVER (PARTITION BY "column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      / sum(cn) OVER (PARTITION BY "column") AS fc,
    lead(value) OVER (PARTITION BY "column" ORDER BY value) AS next_value FROM cdf0)""",
         """ws AS (
  SELECT d."column", d.wasserstein, d.wasserstein / s.sd AS wasserstein_norm FROM
  (SELECT "column", sum(abs(fr - fc) * (next_value - value)) AS wasserstein FROM cdf GROUP BY 1) d
  JOIN (SELECT "column", greatest(stddev_pop(value), 0.001) AS sd FROM rl GROUP BY 1) s USING ("column"))"""]


def psi_sql(cur_bins: str, by: str) -> str:
    """PSI per (by, column) with the reference-bins decomposition."""
    sep = ", " if by else ""
    return f"""rs AS (SELECT "column", bin, n / sum(n) OVER (PARTITION BY "column") AS r FROM rb),
base AS (SELECT "column", sum((0.0001 - r) * ln(0.0001 / r)) AS b FROM rs GROUP BY 1),
cs AS (SELECT {by}{sep}"column", bin, greatest(n / sum(n) OVER (PARTITION BY {by}{sep}"column"), 0.0001) AS c FROM {cur_bins}),
pd AS (SELECT {by}{sep}cs."column",
    sum(CASE WHEN rs.r IS NULL THEN (c - 0.0001) * ln(c / 0.0001)
             ELSE (c - rs.r) * ln(c / rs.r) - (0.0001 - rs.r) * ln(0.0001 / rs.r) END) AS d
  FROM cs LEFT JOIN rs ON cs."column" = rs."column" AND cs.bin = rs.bin GROUP BY ALL),
psi AS (SELECT {by}{sep}pd."column", b + d AS psi FROM pd JOIN base ON pd."column" = base."column")"""


ORACLE["drift_psi"] = w(*DRIFT, psi_sql("cb", "")) + 'SELECT "column", round(psi, 6) AS psi FROM psi'

ORACLE["drift_align"] = w(*DRIFT) + """
SELECT "column", bin, coalesce(rb.n, 0) AS ref_count, coalesce(cb.n, 0) AS cur_count
FROM rb FULL JOIN cb USING ("column", bin)"""

ORACLE["drift_ks"] = w(*DRIFT) + 'SELECT "column", round(max(abs(fr - fc)), 6) AS ks FROM cdf GROUP BY 1'

ORACLE["drift_chi2"] = w(*DRIFT, """x0 AS (
  SELECT "column", value, coalesce(r.rn, 0) AS rn, coalesce(c.cn, 0) AS cn FROM
  (SELECT "column", value, count(*) AS rn FROM rl WHERE "column" IN ('click_count','purchase_count') GROUP BY ALL) r
  FULL JOIN (SELECT "column", value, count(*) AS cn FROM cl WHERE "column" IN ('click_count','purchase_count') GROUP BY ALL) c
  USING ("column", value))""", """x1 AS (
  SELECT *, greatest(rn / sum(rn) OVER (PARTITION BY "column"), 0.0001) * sum(cn) OVER (PARTITION BY "column") AS expected
  FROM x0)""") + """
SELECT "column", round(sum(pow(cn - expected, 2) / expected), 6) AS chi2, count(*) AS n_values FROM x1 GROUP BY 1"""

ORACLE["drift_wasserstein"] = w(*DRIFT) + """
SELECT "column", round(wasserstein, 6) AS wasserstein, round(wasserstein_norm, 6) AS wasserstein_norm FROM ws"""

ORACLE["drift_dataset"] = w(*DRIFT) + """
SELECT count(*) AS n_columns, count(*) FILTER (WHERE wasserstein_norm >= 0.1) AS n_drifted,
  round(count(*) FILTER (WHERE wasserstein_norm >= 0.1) / count(*), 6) AS drift_share,
  count(*) FILTER (WHERE wasserstein_norm >= 0.1) / count(*) >= 0.5 AS dataset_drift,
  round(CASE WHEN count(*) FILTER (WHERE wasserstein_norm >= 0.1) / count(*) >= 0.5 THEN max(wasserstein_norm)
        ELSE 0.0 END, 6) AS drift_score FROM ws"""

ORACLE["max_drift"] = w(*DRIFT) + """
SELECT arg_max("column", wasserstein_norm) AS "column", round(max(wasserstein_norm), 6) AS score FROM ws"""

ORACLE["drift_alert"] = w(*DRIFT,
                          f"""ed AS (SELECT *, timestamp_ms - timestamp_ms % {P.DAY_MS} AS day_ms FROM ev
  WHERE timestamp_ms >= {P.DRIFT_SPLIT_MS} AND timestamp_ms <= {P.AS_OF_MS})""",
                          f"""fd AS (SELECT day_ms, user_id,
    CAST(count(*) AS DOUBLE) / count(DISTINCT coalesce(category, '<null>')) AS avg_time_category,
    CAST(count(*) FILTER (WHERE event_type IN ('click','view')) AS DOUBLE) AS click_count,
    CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS purchase_count,
    CAST((day_ms + {P.DAY_MS} - max(timestamp_ms)) / 60000.0 AS DOUBLE) AS recency
  FROM ed GROUP BY day_ms, user_id)""",
                          """dl AS (UNPIVOT fd ON avg_time_category, click_count, purchase_count, recency INTO NAME "column" VALUE value)""",
                          """db AS (SELECT day_ms, "column", CAST(len(list_filter(edges, lambda e: e < value)) AS BIGINT) AS bin, count(*) AS n
  FROM dl JOIN edges USING ("column") GROUP BY ALL)""", psi_sql("db", "day_ms")) + """
SELECT day_ms, round(max(psi), 6) AS drift_score, max(psi) > 0.2 AS alert FROM psi GROUP BY day_ms"""


_W = 604800000
_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
METRICS = [EV, RAW, CHK, MON, retry_cte("valid", FAILS),
           "mh AS (SELECT *, timestamp_ms - timestamp_ms % 3600000 + 3600000 AS ts_ms FROM mon2)",
           "et AS (SELECT event_type, ts_ms, count(*) AS inc FROM mh GROUP BY event_type, ts_ms)",
           """ve AS (SELECT v.field, e.timestamp_ms - e.timestamp_ms % 3600000 + 3600000 AS ts_ms, count(*) AS inc
  FROM verr v JOIN ev e ON v.event_id = e.event_id GROUP BY 1, 2)""",
           """dq AS (SELECT timestamp_ms - timestamp_ms % 3600000 + 3600000 AS ts_ms, count(*) AS inc
  FROM rt WHERE route = 'dlq' GROUP BY 1)""",
           """hb AS (SELECT ts_ms, count(*) FILTER (WHERE latency_ms <= 10) AS le_10, count(*) FILTER (WHERE latency_ms <= 20) AS le_20,
  count(*) FILTER (WHERE latency_ms <= 50) AS le_50, count(*) FILTER (WHERE latency_ms <= 100) AS le_100,
  count(*) AS le_inf, sum(latency_ms) AS lsum FROM mh GROUP BY ts_ms)""",
           """bk AS (SELECT ts_ms, '10' AS le, le_10 AS inc FROM hb UNION ALL SELECT ts_ms, '20', le_20 FROM hb
  UNION ALL SELECT ts_ms, '50', le_50 FROM hb UNION ALL SELECT ts_ms, '100', le_100 FROM hb
  UNION ALL SELECT ts_ms, '+Inf', le_inf FROM hb)""",
           """hg AS (SELECT ts_ms, max(arrival_ms - timestamp_ms) AS emit_lag, quantile_cont(latency_ms, 0.95) AS p95,
  count(*) FILTER (WHERE event_id % 2 = 0) AS n0, count(*) FILTER (WHERE event_id % 2 = 1) AS n1,
  coalesce(sum(latency_ms) FILTER (WHERE event_id % 2 = 0), 0) AS busy0,
  coalesce(sum(latency_ms) FILTER (WHERE event_id % 2 = 1), 0) AS busy1 FROM mh GROUP BY ts_ms)""",
           """inst AS (SELECT ts_ms, 'tm-0' AS instance, n0 AS n, busy0 AS busy_ms FROM hg
  UNION ALL SELECT ts_ms, 'tm-1', n1, busy1 FROM hg)""",
           """lagt AS (SELECT event_id % 3 AS part, ts_ms, count(*) FILTER (WHERE arrival_ms > ts_ms) AS v FROM mh GROUP BY 1, 2)""",
           f"""metrics AS (
  SELECT 'events_total' AS metric, 'events_total{{event_type=' || event_type || '}}' AS series, NULL AS lab, ts_ms,
    CAST(sum(inc) OVER (PARTITION BY event_type, floor(ts_ms / {_W}) ORDER BY ts_ms {_RUN}) AS DOUBLE) AS value FROM et
  UNION ALL SELECT 'validation_errors_total', 'validation_errors_total{{field=' || field || '}}', field, ts_ms,
    CAST(sum(inc) OVER (PARTITION BY field, floor(ts_ms / {_W}) ORDER BY ts_ms {_RUN}) AS DOUBLE) FROM ve
  UNION ALL SELECT 'dlq_messages_total', 'dlq_messages_total', NULL, ts_ms,
    CAST(sum(inc) OVER (PARTITION BY floor(ts_ms / {_W}) ORDER BY ts_ms {_RUN}) AS DOUBLE) FROM dq
  UNION ALL SELECT 'ml_latency_bucket', 'ml_latency_bucket{{le=' || le || '}}', le, ts_ms,
    CAST(sum(inc) OVER (PARTITION BY le, floor(ts_ms / {_W}) ORDER BY ts_ms {_RUN}) AS DOUBLE) FROM bk
  UNION ALL SELECT 'ml_latency_sum', 'ml_latency_sum', NULL, ts_ms,
    CAST(sum(lsum) OVER (PARTITION BY floor(ts_ms / {_W}) ORDER BY ts_ms {_RUN}) AS DOUBLE) FROM hb
  UNION ALL SELECT 'ml_latency_count', 'ml_latency_count', NULL, ts_ms,
    CAST(sum(le_inf) OVER (PARTITION BY floor(ts_ms / {_W}) ORDER BY ts_ms {_RUN}) AS DOUBLE) FROM hb
  UNION ALL SELECT 'kafka_consumergroup_lag',
    'kafka_consumergroup_lag{{consumergroup=recs,partition=' || CAST(part AS VARCHAR) || ',topic=user_events}}',
    CAST(part AS VARCHAR), ts_ms, CAST(v AS DOUBLE) FROM lagt
  UNION ALL SELECT 'flink_taskmanager_job_task_operator_currentEmitEventTimeLag',
    'flink_taskmanager_job_task_operator_currentEmitEventTimeLag{{operator_name=score}}', NULL, ts_ms,
    CAST(emit_lag AS DOUBLE) FROM hg
  UNION ALL SELECT 'ml_inference_latency_p95', 'ml_inference_latency_p95', NULL, ts_ms, p95 FROM hg
  UNION ALL SELECT 'up', 'up{{instance=' || instance || ',job=flink}}', instance, ts_ms,
    CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END FROM inst
  UNION ALL SELECT 'node_cpu_seconds_total', 'node_cpu_seconds_total{{instance=' || instance || ',mode=idle}}', instance, ts_ms,
    sum(3600.0 - busy_ms / 1000.0) OVER (PARTITION BY instance, floor(ts_ms / {_W}) ORDER BY ts_ms {_RUN}) FROM inst
  UNION ALL SELECT 'node_memory_MemTotal_bytes', 'node_memory_MemTotal_bytes{{instance=' || instance || '}}', instance,
    ts_ms, 8589934592.0 FROM inst
  UNION ALL SELECT 'node_memory_MemAvailable_bytes', 'node_memory_MemAvailable_bytes{{instance=' || instance || '}}',
    instance, ts_ms, 8589934592.0 - n * 134217728.0 FROM inst)""",
           f"""dl AS (SELECT *, CASE WHEN lag(value) OVER s IS NULL THEN 0.0 WHEN value < lag(value) OVER s THEN value
    ELSE value - lag(value) OVER s END AS dlt FROM metrics WINDOW s AS (PARTITION BY series ORDER BY ts_ms))""",
           f"""inc AS (SELECT *, sum(dlt) OVER (PARTITION BY series ORDER BY ts_ms
    RANGE BETWEEN {P.METRIC_RANGE_MS - 1} PRECEDING AND CURRENT ROW) AS increase,
    min(ts_ms) OVER (PARTITION BY series) AS t0,
    sum(dlt) OVER (PARTITION BY series ORDER BY ts_ms RANGE BETWEEN {P.METRIC_RANGE_MS - 1} PRECEDING AND CURRENT ROW)
      / {P.METRIC_RANGE_MS / 1000.0} AS rate FROM dl)""",
           """lat AS (SELECT metric, series, lab, max(ts_ms) AS ts_ms, arg_max(value, ts_ms) AS value FROM metrics GROUP BY ALL)""",
           f"""cpu AS (SELECT ts_ms, lab AS instance, 100.0 - avg(rate) * 100 AS value FROM inc
  WHERE metric = 'node_cpu_seconds_total' AND ts_ms - t0 >= {P.METRIC_RANGE_MS} GROUP BY ts_ms, lab)""",
           """mem AS (SELECT ts_ms, lab AS instance,
  (max(value) FILTER (WHERE metric = 'node_memory_MemTotal_bytes') - max(value) FILTER (WHERE metric = 'node_memory_MemAvailable_bytes'))
  / max(value) FILTER (WHERE metric = 'node_memory_MemTotal_bytes') * 100 AS value
  FROM metrics WHERE metric IN ('node_memory_MemTotal_bytes', 'node_memory_MemAvailable_bytes') GROUP BY ts_ms, lab)"""]

ORACLE["m_threshold"] = w(*METRICS) + """
SELECT metric, series, ts_ms, round(value, 6) AS value,
  CASE WHEN metric = 'ml_inference_latency_p95' THEN value > 75.0 ELSE value > 1000.0 END AS firing
FROM lat WHERE metric IN ('kafka_consumergroup_lag', 'flink_taskmanager_job_task_operator_currentEmitEventTimeLag',
  'ml_inference_latency_p95')"""

ORACLE["m_increase"] = w(*METRICS) + "SELECT series, ts_ms, round(increase, 6) AS increase FROM inc WHERE metric = 'events_total'"

ORACLE["m_up"] = w(*METRICS) + "SELECT series, ts_ms, value, value = 0.0 AS firing FROM lat WHERE metric = 'up'"

ORACLE["m_rate"] = w(*METRICS) + """
SELECT series, ts_ms, round(rate, 6) AS rate FROM inc WHERE metric IN ('dlq_messages_total', 'events_total')"""

ORACLE["m_sum_by"] = w(*METRICS) + """
SELECT lab AS field, round(sum(value), 6) AS value FROM lat WHERE metric = 'validation_errors_total' GROUP BY lab"""

ORACLE["m_hist_quantile"] = w(*METRICS, """hq0 AS (
  SELECT ts_ms, lab AS le, sum(rate) AS c, CASE WHEN lab = '+Inf' THEN 'inf'::DOUBLE ELSE CAST(lab AS DOUBLE) END AS bound
  FROM inc WHERE metric = 'ml_latency_bucket' GROUP BY ts_ms, lab)""", """hq1 AS (
  SELECT *, coalesce(lag(bound) OVER w, 0.0) AS prev_bound, coalesce(lag(c) OVER w, 0.0) AS prev_c,
    max(CASE WHEN le = '+Inf' THEN c END) OVER (PARTITION BY ts_ms) AS total,
    max(CASE WHEN le <> '+Inf' THEN bound END) OVER (PARTITION BY ts_ms) AS max_finite
  FROM hq0 WINDOW w AS (PARTITION BY ts_ms ORDER BY bound))""", """hq2 AS (
  SELECT * FROM hq1 WHERE c >= total * 0.95 AND total > 0
  QUALIFY row_number() OVER (PARTITION BY ts_ms ORDER BY bound) = 1)""") + """
SELECT ts_ms, round(CASE WHEN bound = 'inf'::DOUBLE THEN max_finite
  ELSE prev_bound + (bound - prev_bound) * (total * 0.95 - prev_c) / (c - prev_c) END, 6) AS quantile FROM hq2"""

ORACLE["m_avg_latency"] = w(*METRICS) + """
SELECT ts_ms, round(CASE WHEN sum(rate) FILTER (WHERE metric = 'ml_latency_count') > 0 THEN
  sum(rate) FILTER (WHERE metric = 'ml_latency_sum') / sum(rate) FILTER (WHERE metric = 'ml_latency_count') END, 6) AS value
FROM inc WHERE metric IN ('ml_latency_sum', 'ml_latency_count') GROUP BY ts_ms"""

ORACLE["m_cpu"] = w(*METRICS) + "SELECT ts_ms, instance, round(value, 6) AS value, value > 80.0 AS firing FROM cpu"

ORACLE["m_mem"] = w(*METRICS) + "SELECT ts_ms, instance, round(value, 6) AS value, value > 90.0 AS firing FROM mem"

ORACLE["m_series"] = w(*METRICS) + """
SELECT ts_ms, 'recs' AS consumergroup, lab AS partition, round(value, 6) AS value FROM metrics
WHERE metric = 'kafka_consumergroup_lag'"""

_RULES = """rules AS (SELECT * FROM (VALUES
  ('HighKafkaLag', 'kafka_consumergroup_lag', '>', 1000.0, 5, 'critical'),
  ('KafkaUnderReplicatedPartitions', 'kafka_topic_partition_under_replicated_partition', '>', 0.0, 2, 'warning'),
  ('HighFlinkProcessingLatency', 'flink_taskmanager_job_task_operator_currentEmitEventTimeLag', '>', 1000.0, 1, 'warning'),
  ('FlinkCheckpointFailures', 'increase:flink_jobmanager_job_numberOfFailedCheckpoints', '>', 0.0, 2, 'critical'),
  ('FlinkTaskManagerDown', 'up', '==', 0.0, 1, 'critical'),
  ('FlinkBackpressure', 'flink_taskmanager_job_task_backPressuredTimeMsPerSecond', '>', 500.0, 2, 'warning'),
  ('HighMLInferenceLatency', 'ml_inference_latency_p95', '>', 75.0, 5, 'warning'),
  ('MLModelPredictionDrift', 'data_drift_score', '>', 0.2, 10, 'warning'),
  ('HighDLQRate', 'rate:dlq_messages_total', '>', 0.1, 5, 'warning'),
  ('HighMemoryUsage', 'memory_used_pct', '>', 90.0, 5, 'warning'),
  ('HighCPUUsage', 'cpu_busy_pct', '>', 80.0, 5, 'warning')) t(alert, expr, op, bound, for_min, severity))"""

ORACLE["alerts"] = w(*METRICS, _RULES, """ri AS (
  SELECT metric AS expr, series, ts_ms, value FROM metrics
  UNION ALL SELECT 'increase:' || metric, series, ts_ms, increase FROM inc
    WHERE metric IN ('dlq_messages_total', 'flink_jobmanager_job_numberOfFailedCheckpoints')
  UNION ALL SELECT 'rate:' || metric, series, ts_ms, rate FROM inc
    WHERE metric IN ('dlq_messages_total', 'flink_jobmanager_job_numberOfFailedCheckpoints')
  UNION ALL SELECT 'cpu_busy_pct', 'cpu{instance=' || instance || '}', ts_ms, value FROM cpu
  UNION ALL SELECT 'memory_used_pct', 'memory{instance=' || instance || '}', ts_ms, value FROM mem)""", """ct AS (
  SELECT r.alert, r.severity, i.series, i.ts_ms, r.for_min, coalesce(
    CASE WHEN r.op = '>' THEN i.value > r.bound WHEN r.op = '==' THEN i.value = r.bound ELSE i.value < r.bound END, false) AS c
  FROM ri i JOIN rules r ON i.expr = r.expr)""",
                     """isl AS (SELECT *, sum(CASE WHEN prev IS NULL OR NOT was OR ts_ms - prev > 3600000 THEN 1 ELSE 0 END)
  OVER (PARTITION BY alert, severity, series ORDER BY ts_ms ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k
  FROM (SELECT *, lag(ts_ms) OVER s AS prev, lag(c) OVER s AS was FROM ct
        WINDOW s AS (PARTITION BY alert, severity, series ORDER BY ts_ms)))""") + """
SELECT alert, severity, series, min(ts_ms) AS start_ms, max(ts_ms) AS end_ms, min(ts_ms) + any_value(for_min) * 60000 AS fires_from_ms,
  max(ts_ms) >= min(ts_ms) + any_value(for_min) * 60000 AS fired FROM isl WHERE c GROUP BY alert, severity, series, k"""

ORACLE["alert_for"] = w(*METRICS, """ct AS (SELECT series, ts_ms, value > 75.0 AS c FROM metrics WHERE metric = 'ml_inference_latency_p95')""",
                        """isl AS (SELECT *, sum(CASE WHEN prev IS NULL OR NOT was OR ts_ms - prev > 3600000 THEN 1 ELSE 0 END)
  OVER (PARTITION BY series ORDER BY ts_ms ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k
  FROM (SELECT *, lag(ts_ms) OVER s AS prev, lag(c) OVER s AS was FROM ct WINDOW s AS (PARTITION BY series ORDER BY ts_ms)))""") + """
SELECT series, min(ts_ms) AS start_ms, max(ts_ms) AS end_ms, min(ts_ms) + 300000 AS fires_from_ms,
  max(ts_ms) >= min(ts_ms) + 300000 AS fired FROM isl WHERE c GROUP BY series, k"""

# values of all rules and panels: rates over the time that samples cover, labels as in the series' name
_EVALUATED = [*METRICS, "drift AS (" + ORACLE["drift_alert"] + ")",
              """smp AS (SELECT metric, series, ts_ms, value FROM metrics
  UNION ALL SELECT 'data_drift_score', 'data_drift_score', day_ms + 86400000, drift_score FROM drift)""",
              f"""rng AS (SELECT metric, ts_ms, value, regexp_extract(series, '\\{{(.*)\\}}', 1) AS labels, sum(rise) OVER r AS increase,
    sum(step) OVER r AS covered FROM (SELECT *, CASE WHEN lag(value) OVER s IS NULL THEN 0.0 WHEN value < lag(value) OVER s THEN value
      ELSE value - lag(value) OVER s END AS rise, CASE WHEN lag(ts_ms) OVER s IS NULL THEN 0 ELSE least(ts_ms - lag(ts_ms) OVER s, 3600000) END AS step
      FROM smp WINDOW s AS (PARTITION BY series ORDER BY ts_ms))
    WINDOW r AS (PARTITION BY series ORDER BY ts_ms RANGE BETWEEN {P.METRIC_RANGE_MS - 1} PRECEDING AND CURRENT ROW))""",
              """rt8 AS (SELECT *, increase * 1000.0 / covered AS rate FROM rng WHERE covered > 0)""",
              """vals AS (SELECT metric AS name, labels, ts_ms, value FROM rng WHERE metric IN ('kafka_consumergroup_lag',
    'flink_taskmanager_job_task_operator_currentEmitEventTimeLag', 'ml_inference_latency_p95', 'data_drift_score', 'up')
  UNION ALL SELECT 'dlq_rate', labels, ts_ms, rate FROM rt8 WHERE metric = 'dlq_messages_total'
  UNION ALL SELECT 'throughput_per_s', '', ts_ms, sum(rate) FROM rt8 WHERE metric = 'events_total' GROUP BY ts_ms
  UNION ALL SELECT 'cpu_busy_pct', regexp_extract(labels, 'instance=[^,]*'), ts_ms, 100.0 - avg(rate) * 100 FROM rt8
    WHERE metric = 'node_cpu_seconds_total' GROUP BY ALL
  UNION ALL SELECT 'memory_used_pct', 'instance=' || instance, ts_ms, value FROM mem)"""]

ORACLE["alert_rules"] = w(*_EVALUATED, _RULES, """ct AS (
  SELECT alert, severity, labels, ts_ms, for_min, CASE WHEN op = '>' THEN value > bound ELSE value = bound END AS c
  FROM vals JOIN rules ON name = CASE expr WHEN 'rate:dlq_messages_total' THEN 'dlq_rate' ELSE expr END)""",
                          """isl AS (SELECT *, sum(CASE WHEN prev IS NULL OR NOT was OR ts_ms - prev > 3600000 THEN 1 ELSE 0 END)
  OVER (PARTITION BY alert, severity, labels ORDER BY ts_ms ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k
  FROM (SELECT *, lag(ts_ms) OVER s AS prev, lag(c) OVER s AS was FROM ct
        WINDOW s AS (PARTITION BY alert, severity, labels ORDER BY ts_ms)))""") + """
SELECT alert, severity, labels, min(ts_ms) AS start_ms, max(ts_ms) AS end_ms, min(ts_ms) + any_value(for_min) * 60000 AS fires_from_ms,
  max(ts_ms) >= min(ts_ms) + any_value(for_min) * 60000 AS fired FROM isl WHERE c GROUP BY alert, severity, labels, k"""

ORACLE["panels"] = w(*_EVALUATED, """now AS (SELECT name AS metric, labels, arg_max(value, ts_ms) AS value FROM vals
  WHERE name IN ('kafka_consumergroup_lag', 'ml_inference_latency_p95', 'data_drift_score', 'cpu_busy_pct', 'memory_used_pct',
    'throughput_per_s') GROUP BY ALL)""") + """
SELECT metric, labels, round(value + 1e-9, 6) AS value, CASE metric
  WHEN 'kafka_consumergroup_lag' THEN CASE WHEN value >= 1000 THEN 'red' WHEN value >= 500 THEN 'yellow' ELSE 'green' END
  WHEN 'ml_inference_latency_p95' THEN CASE WHEN value >= 75 THEN 'red' WHEN value >= 50 THEN 'yellow' ELSE 'green' END
  WHEN 'data_drift_score' THEN CASE WHEN value >= 0.2 THEN 'red' WHEN value >= 0.1 THEN 'yellow' ELSE 'green' END
  WHEN 'throughput_per_s' THEN CASE WHEN value >= 500 THEN 'green' WHEN value >= 100 THEN 'yellow' ELSE 'red' END
  ELSE CASE WHEN value >= 90 THEN 'red' WHEN value >= 70 THEN 'yellow' ELSE 'green' END END AS band FROM now"""

ORACLE["m_cpu_covered"] = w(*_EVALUATED) + """
SELECT labels, ts_ms, round(value + 1e-9, 6) AS value FROM vals WHERE name = 'cpu_busy_pct'"""

ORACLE["m_hist_quantile_by"] = w(EV, MON, """ob AS (SELECT load_scenario AS operator, timestamp_ms - timestamp_ms % 3600000 + 3600000 AS ts_ms,
    count(*) FILTER (WHERE latency_ms <= 10) AS b10, count(*) FILTER (WHERE latency_ms <= 20) AS b20,
    count(*) FILTER (WHERE latency_ms <= 50) AS b50, count(*) FILTER (WHERE latency_ms <= 100) AS b100, count(*) AS binf
    FROM mon2 GROUP BY ALL)""", """ox AS (SELECT operator, ts_ms, unnest([10.0, 20.0, 50.0, 100.0, 'inf'::DOUBLE]) AS bound,
    unnest([b10, b20, b50, b100, binf]) AS inc FROM ob)""", f"""oc AS (SELECT *, sum(inc) OVER (PARTITION BY operator, bound,
    floor(ts_ms / {_W}) ORDER BY ts_ms {_RUN}) AS value FROM ox)""",
    """od AS (SELECT *, CASE WHEN lag(value) OVER s IS NULL THEN 0.0 WHEN value < lag(value) OVER s THEN value
    ELSE value - lag(value) OVER s END AS rise FROM oc WINDOW s AS (PARTITION BY operator, bound ORDER BY ts_ms))""",
    f"""oq AS (SELECT operator, ts_ms, bound, sum(rise) OVER (PARTITION BY operator, bound ORDER BY ts_ms
    RANGE BETWEEN {P.METRIC_RANGE_MS - 1} PRECEDING AND CURRENT ROW) / {P.METRIC_RANGE_MS / 1000.0} AS c FROM od)""",
    """op AS (SELECT *, coalesce(lag(bound) OVER s, 0.0) AS pb, coalesce(lag(c) OVER s, 0.0) AS pc,
    max(CASE WHEN bound = 'inf'::DOUBLE THEN c END) OVER g AS total FROM oq
    WINDOW s AS (PARTITION BY operator, ts_ms ORDER BY bound), g AS (PARTITION BY operator, ts_ms))""",
    """oh AS (SELECT * FROM op WHERE total > 0 AND c >= total * 0.95 QUALIFY row_number() OVER (PARTITION BY operator, ts_ms ORDER BY bound) = 1)""") + """
SELECT ts_ms, 'flink' AS job, operator, round(CASE WHEN bound = 'inf'::DOUBLE THEN 100.0
  ELSE pb + (bound - pb) * (total * 0.95 - pc) / (c - pc) END, 6) AS quantile FROM oh"""

ORACLE["m_bands"] = w(*METRICS, """bands AS (SELECT * FROM (VALUES
  ('kafka_consumergroup_lag', 0.0, 'green'), ('kafka_consumergroup_lag', 500.0, 'yellow'), ('kafka_consumergroup_lag', 1000.0, 'red'),
  ('ml_inference_latency_p95', 0.0, 'green'), ('ml_inference_latency_p95', 50.0, 'yellow'), ('ml_inference_latency_p95', 75.0, 'red'),
  ('cpu_busy_pct', 0.0, 'green'), ('cpu_busy_pct', 70.0, 'yellow'), ('cpu_busy_pct', 90.0, 'red'),
  ('memory_used_pct', 0.0, 'green'), ('memory_used_pct', 70.0, 'yellow'), ('memory_used_pct', 90.0, 'red')) t(bmetric, bound, band))""",
                       """vals AS (
  SELECT metric, series, value FROM lat WHERE metric IN ('kafka_consumergroup_lag', 'ml_inference_latency_p95')
  UNION ALL SELECT 'cpu_busy_pct', 'cpu_busy_pct{instance=' || instance || '}', arg_max(value, ts_ms) FROM cpu GROUP BY instance
  UNION ALL SELECT 'memory_used_pct', 'memory_used_pct{instance=' || instance || '}', arg_max(value, ts_ms) FROM mem GROUP BY instance)""") + """
SELECT metric, series, round(value, 6) AS value, coalesce(arg_max(band, bound) FILTER (WHERE bound <= value),
  CASE WHEN value IS NOT NULL THEN arg_min(band, bound) END) AS band
FROM vals LEFT JOIN bands ON metric = bmetric GROUP BY metric, series, value"""


ORACLE["src_multi_topic"] = w(EV, RAW, CHK, retry_cte("valid", FAILS)) + """
SELECT 'user_events' AS topic, count(*) AS n_messages, count(DISTINCT user_id) AS n_users FROM ev
UNION ALL SELECT 'ml_predictions_success', count(*), count(DISTINCT user_id) FROM rt WHERE route = 'success'
UNION ALL SELECT 'validation_errors', count(*), count(DISTINCT user_id) FROM verr
UNION ALL SELECT 'dlq_fatal_errors', count(*), count(DISTINCT user_id) FROM rt WHERE route = 'dlq' HAVING count(*) > 0"""

ORACLE["route_topic"] = w(EV, RAW, CHK, retry_cte("valid", FAILS)) + """
SELECT 'ml_predictions_success' AS topic, event_id FROM rt WHERE route = 'success'"""

ORACLE["sink_json"] = w(EV) + """
SELECT json_object('user_id', user_id, 'event_count', count(*))::VARCHAR AS value, user_id, count(*) AS event_count
FROM ev GROUP BY user_id"""

ORACLE["hist_store"] = w(EV, hist_cte("ev", P.AS_OF_MS, 100)) + """
SELECT user_id, pos, event_id,
  json_object('event_type', event_type, 'category', category, 'timestamp_ms', timestamp_ms)::VARCHAR AS entry FROM hist"""

ORACLE["parse_tolerant"] = w(EV, f"""m AS (SELECT user_id, event_id,
  CASE WHEN event_id % 13 = 0 THEN substring({_EVENT_JSON}, 1, length({_EVENT_JSON}) - 1) ELSE {_EVENT_JSON} END AS v
  FROM ev)""") + """
SELECT user_id, count(*) AS n_messages, count(*) FILTER (WHERE json_valid(v)) AS n_parsed,
  count(*) FILTER (WHERE NOT json_valid(v)) AS n_corrupt FROM m GROUP BY user_id"""

ORACLE["defaults"] = w(EV, f"upto AS (SELECT * FROM ev WHERE timestamp_ms <= {P.COLD_AS_OF_MS})",
                       hist_cte("upto", P.COLD_AS_OF_MS, 100), feats_cte("hist", P.COLD_AS_OF_MS),
                       """j AS (
  SELECT u.user_id, coalesce(h.category, 'unknown') AS last_category, f.avg_time_category IS NOT NULL AS has_history,
    coalesce(f.avg_time_category, 0.0) AS avg_time_category, coalesce(f.click_count, 0.0) AS click_count,
    coalesce(f.purchase_count, 0.0) AS purchase_count, coalesce(f.recency, 1440.0) AS recency
  FROM (SELECT DISTINCT user_id FROM ev) u LEFT JOIN feats f USING (user_id)
  LEFT JOIN (SELECT user_id, category FROM hist WHERE pos = 1) h USING (user_id))""") + f"""
SELECT user_id, last_category, has_history, round(avg_time_category, 6) AS avg_time_category,
  round(click_count, 6) AS click_count, round(purchase_count, 6) AS purchase_count, round(recency, 6) AS recency,
  round({score_sql()}, 6) AS prediction FROM j"""

ORACLE["assemble"] = w(EV, online_cte("ev", P.CHECK_LIMIT)) + """
SELECT event_id, round(avg_time_category, 6) AS f0, round(click_count, 6) AS f1, round(purchase_count, 6) AS f2,
  round(recency, 6) AS f3 FROM onl"""


ORACLE["watermark"] = ORACLE["user_counts"]

ORACLE["late_stream"] = ORACLE["late_split"]

# rows of a micro-batch are late by the watermark that the batch before last had set
ORACLE["watermark_late"] = w(EV, MON, f"""a AS (SELECT event_id, timestamp_ms,
  CASE WHEN event_id % {P.LATE_EVERY} = 0 THEN timestamp_ms + {P.LATE_BY_MS} ELSE arrival_ms END AS arrival_ms FROM mon2)""",
    f"""b AS (SELECT *, CAST(floor((arrival_ms - min(arrival_ms) OVER ()) * {P.SLICES}
    / (max(arrival_ms) OVER () - min(arrival_ms) OVER () + 1)) AS INTEGER) AS batch FROM a)""",
    f"""m AS (SELECT batch, max(max(timestamp_ms)) OVER (ORDER BY batch) - {P.WATERMARK_MS} AS mark FROM b GROUP BY batch)""",
    f"""c AS (SELECT b.*, timestamp_ms - timestamp_ms % {P.HOUR_MS} AS window_start_ms,
    coalesce((SELECT max(mark) FROM m WHERE m.batch < b.batch - 1), 0) AS mark FROM b)""") + f"""
SELECT window_start_ms, count(*) AS n_events FROM c WHERE window_start_ms + {P.HOUR_MS} > mark GROUP BY 1"""

ORACLE["state_ttl"] = w(EV, f"""g AS (SELECT user_id, timestamp_ms, event_id,
  CASE WHEN timestamp_ms - lag(timestamp_ms) OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id) < {P.STATE_TTL_MS}
    THEN 0 ELSE 1 END AS brk FROM ev)""",
    """s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY timestamp_ms, event_id) AS no FROM g)""") + f"""
SELECT user_id, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms, count(*) AS n_events,
  max(timestamp_ms) + {P.STATE_TTL_MS} AS expired_ms FROM s GROUP BY user_id, no"""

ORACLE["recovery"] = w(EV) + "SELECT user_id, count(*) AS n_events, count(DISTINCT event_id) AS n_distinct FROM ev GROUP BY user_id"

ORACLE["retry_state"] = w(EV, retry_cte("ev", "event_type = 'error'")) + """
SELECT event_id, user_id, route, CAST(retry_count AS BIGINT) AS retry_count FROM rt"""

ORACLE["retry_replay"] = w(EV, retry_cte("ev", "event_type = 'error'")) + """
SELECT user_id, 'replay_success' AS route, count(*) AS n FROM rt WHERE route = 'retry' GROUP BY user_id"""


ORACLE["feature_lookup"] = w(EV, hist_cte("ev", P.DRIFT_SPLIT_MS, 100), feats_cte("hist", P.DRIFT_SPLIT_MS)) + """
SELECT e.event_id, e.user_id, f.avg_time_category IS NOT NULL AS has_history,
  round(coalesce(f.avg_time_category, 0.0), 6) AS avg_time_category, round(coalesce(f.click_count, 0.0), 6) AS click_count,
  round(coalesce(f.purchase_count, 0.0), 6) AS purchase_count, round(coalesce(f.recency, 1440.0), 6) AS recency
FROM ev e LEFT JOIN feats f USING (user_id)"""
