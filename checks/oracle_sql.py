"""DuckDB SQL for every registered query, over the driver's raw tables.

The shared CTEs restate the fixture mapping and the rate rule in plain SQL;
each key adds its final SELECT. Sums are cast to BIGINT (DuckDB widens them
to HUGEINT) and ratios to DOUBLE, so types line up with Spark's.
"""

from __future__ import annotations

from surgeflow.fixture import (ALTERED, ALTERED_MODULUS, ARRIVAL_DELAYS, DEAD_LETTER_DAYS, FIXTURE_CONFIG, LATE_DELAY_SECONDS, MISSING_FIELDS,
                               PHASE_OFFSET_MS, PIPELINE_CONFIG, PIPELINE_DAYS, SAMPLE_SECONDS, TRAILING_SECONDS,
                               WINDOW_CONFIG, WINDOW_SECONDS, WRITTEN_CONFIG)

STAMP = ("(TIMESTAMP '2024-01-01' + INTERVAL (CAST(batch_id // 3 AS INTEGER)) MINUTE"
         " + INTERVAL (CAST(batch_id % 3 * 20 AS INTEGER)) SECOND)")
RATE = repr(float(FIXTURE_CONFIG.rate_per_sec))
RATE_TEXT = FIXTURE_CONFIG.rate_text
FLOOR_US = FIXTURE_CONFIG.floor_us
WINDOW_REASON = f"ip_rate_exceeded_{WINDOW_CONFIG.rate_text}_events_per_sec_over_{WINDOW_SECONDS}.0s_span"

BASE = f"""
ev AS (
  SELECT printf('%032x', event_id) AS event_id,
         printf('user_%06d', user_id) AS user_id,
         event_type AS action,
         printf('PRD-%04d', CAST(json_extract(props, '$.k') AS BIGINT)) AS product_id,
         '10.0.0.' || CAST(user_id AS VARCHAR) AS ip_address,
         ts AS event_ts,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS batch_id,
         event_id AS src_id,
         user_id AS src_user
  FROM events
),
bs AS (
  SELECT batch_id, COUNT(*) AS total_events, MIN(event_ts) AS min_ts, MAX(event_ts) AS max_ts,
         epoch_us(MAX(event_ts)) - epoch_us(MIN(event_ts)) AS raw_us
  FROM ev GROUP BY batch_id
),
sp AS (
  SELECT *, raw_us / 1e6 AS raw_span_sec,
         span_us / 1e6 AS span_sec,
         CAST({RATE} AS DOUBLE) * (span_us / 1e6) AS threshold,
         'ip_rate_exceeded_{RATE_TEXT}_events_per_sec_over_'
           || CAST(((span_us + 50000) // 100000) // 10 AS VARCHAR) || '.'
           || CAST(((span_us + 50000) // 100000) % 10 AS VARCHAR) || 's_span' AS reason
  FROM (SELECT *, greatest(raw_us, {FLOOR_US}) AS span_us FROM bs)
),
ipc AS (SELECT batch_id, ip_address, COUNT(*) AS n FROM ev GROUP BY batch_id, ip_address),
rt AS (
  SELECT ipc.batch_id, ipc.ip_address, ipc.n, sp.span_sec, sp.threshold,
         ipc.n > sp.threshold AS is_bot, sp.reason
  FROM ipc JOIN sp ON ipc.batch_id = sp.batch_id
),
bots AS (SELECT batch_id, ip_address, reason FROM rt WHERE is_bot),
flagged AS (
  SELECT ev.event_id, ev.user_id, ev.action, ev.product_id, ev.ip_address, ev.event_ts,
         ev.batch_id, bots.reason
  FROM ev JOIN bots ON ev.batch_id = bots.batch_id AND ev.ip_address = bots.ip_address
),
clean AS (
  SELECT ev.event_id, ev.user_id, ev.action, ev.product_id, ev.ip_address, ev.event_ts, ev.batch_id
  FROM ev WHERE NOT EXISTS (SELECT 1 FROM bots b
                            WHERE b.batch_id = ev.batch_id AND b.ip_address = ev.ip_address)
),
agg_deltas AS (
  SELECT batch_id, date_trunc('minute', {STAMP}) AS window_start,
         product_id, action, COUNT(*) AS event_count
  FROM clean GROUP BY batch_id, product_id, action
),
agg AS (
  SELECT window_start, product_id, action, CAST(SUM(event_count) AS BIGINT) AS event_count
  FROM agg_deltas GROUP BY window_start, product_id, action
),
stamps AS (
  SELECT batch_id, {STAMP} AS batch_ts,
         CAST(SUM(src_id % 97) AS BIGINT) AS processing_time_ms
  FROM ev GROUP BY batch_id
),
bm AS (
  SELECT batch_id,
         CAST(SUM(n) AS BIGINT) AS total_events,
         CAST(SUM(n) - SUM(CASE WHEN is_bot THEN n ELSE 0 END) AS BIGINT) AS legit_events,
         CAST(SUM(CASE WHEN is_bot THEN n ELSE 0 END) AS BIGINT) AS flagged_events,
         COUNT(*) AS distinct_ips,
         COUNT(CASE WHEN is_bot THEN 1 END) AS distinct_flagged_ips
  FROM rt GROUP BY batch_id
),
pe AS (SELECT *, batch_id // {PIPELINE_DAYS} AS b FROM ev),
ps AS (
  SELECT b, greatest(epoch_us(MAX(event_ts)) - epoch_us(MIN(event_ts)), {PIPELINE_CONFIG.floor_us}) AS us FROM pe GROUP BY b
),
pv AS (
  SELECT pe.*, COUNT(*) OVER (PARTITION BY pe.b, ip_address) > CAST({float(PIPELINE_CONFIG.rate_per_sec)!r} AS DOUBLE) * (us / 1e6) AS is_bot,
         'ip_rate_exceeded_{PIPELINE_CONFIG.rate_text}_events_per_sec_over_' || CAST(((us + 50000) // 100000) // 10 AS VARCHAR)
           || '.' || CAST(((us + 50000) // 100000) % 10 AS VARCHAR) || 's_span' AS reason
  FROM pe JOIN ps ON pe.b = ps.b
),
wv AS (
  SELECT *, n > threshold AS is_bot FROM (
    SELECT time_bucket(INTERVAL {WINDOW_SECONDS} SECOND, event_ts, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL {WINDOW_SECONDS} SECOND, event_ts, TIMESTAMP '1970-01-01') + INTERVAL {WINDOW_SECONDS} SECOND AS window_end,
           ip_address, COUNT(*) AS n, CAST({WINDOW_CONFIG.rate_per_sec!r} * {float(WINDOW_SECONDS)!r} AS DOUBLE) AS threshold
    FROM ev GROUP BY 1, 2, 3) c
),
metrics AS (
  SELECT bm.batch_id, stamps.batch_ts, bm.total_events, bm.legit_events, bm.flagged_events,
         bm.distinct_ips, bm.distinct_flagged_ips, stamps.processing_time_ms
  FROM bm JOIN stamps ON bm.batch_id = stamps.batch_id
)
"""

FINAL = {
    "encode_messages": """
SELECT product_id AS key,
       '{"event_id":"' || event_id || '","user_id":"' || user_id || '","action":"' || action
       || '","product_id":"' || product_id || '","timestamp":"'
       || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00","ip_address":"' || ip_address
       || '"}' AS value
FROM ev""",
    "parse_events": """
SELECT event_id, user_id, action, product_id, ip_address, event_ts FROM ev""",
    "validate_events": """
SELECT event_id, user_id, action, product_id, ip_address, event_ts,
       nullif(concat_ws(',', CASE WHEN user_id IS NULL THEN 'user_id' END, CASE WHEN product_id IS NULL THEN 'product_id' END,
                        CASE WHEN ip_address IS NULL THEN 'ip_address' END, CASE WHEN event_ts IS NULL THEN 'event_ts' END), '') AS error
FROM (SELECT event_id, action, """ + ", ".join(
        f"CASE WHEN src_id % 100 <> {k} THEN {c} END AS {c}" for k, c in MISSING_FIELDS.items()) + """ FROM ev) sent""",
    "batch_span": """
SELECT batch_id, total_events, min_ts, max_ts, raw_span_sec, span_sec, threshold FROM sp""",
    "ip_rate": """
SELECT batch_id, ip_address, n, span_sec, threshold, is_bot FROM rt""",
    "flag_reason": """
SELECT batch_id, ip_address, reason FROM bots""",
    "flagged_events": """
SELECT * FROM flagged""",
    "clean_events": """
SELECT * FROM clean""",
    "events_agg": """
SELECT batch_id, window_start, product_id, action, event_count FROM agg_deltas""",
    "upsert_events_agg": """
SELECT window_start, product_id, action, event_count FROM agg""",
    "batch_metrics": """
SELECT batch_id, total_events, legit_events, flagged_events, distinct_ips, distinct_flagged_ips
FROM bm""",
    "conservation": """
SELECT m.batch_id, m.total_events, m.legit_events, m.flagged_events,
       COALESCE(c.clean_rows, 0) AS clean_rows, COALESCE(f.flagged_rows, 0) AS flagged_rows,
       (m.total_events = COALESCE(c.clean_rows, 0) + COALESCE(f.flagged_rows, 0)
        AND m.legit_events = COALESCE(c.clean_rows, 0)
        AND m.flagged_events = COALESCE(f.flagged_rows, 0)) AS balanced
FROM bm m
LEFT JOIN (SELECT batch_id, COUNT(*) AS clean_rows FROM clean GROUP BY batch_id) c
  ON m.batch_id = c.batch_id
LEFT JOIN (SELECT batch_id, COUNT(*) AS flagged_rows FROM flagged GROUP BY batch_id) f
  ON m.batch_id = f.batch_id""",
    "micro_batch_split": """
SELECT m.*, COALESCE(c.n, 0) AS clean_rows, COALESCE(f.n, 0) AS flagged_rows, COALESCE(c.n, 0) AS agg_events
FROM metrics m
LEFT JOIN (SELECT batch_id, COUNT(*) AS n FROM clean GROUP BY batch_id) c ON m.batch_id = c.batch_id
LEFT JOIN (SELECT batch_id, COUNT(*) AS n FROM flagged GROUP BY batch_id) f ON m.batch_id = f.batch_id""",
    "batch_pipeline": f"""
SELECT 'events_clean' AS table_name, b AS batch_id, event_id AS k0, ip_address AS k1, CAST(NULL AS VARCHAR) AS k2,
       CAST(1 AS BIGINT) AS n FROM pv WHERE NOT is_bot
UNION ALL SELECT 'events_flagged', b, event_id, ip_address, reason, 1 FROM pv WHERE is_bot
UNION ALL SELECT 'events_agg', NULL, product_id, action, NULL, COUNT(*) FROM pv WHERE NOT is_bot GROUP BY product_id, action
UNION ALL SELECT 'pipeline_metrics', b, CAST(COUNT(*) FILTER (NOT is_bot) AS VARCHAR),
       CAST(COUNT(*) FILTER (is_bot) AS VARCHAR), CAST(COUNT(DISTINCT ip_address) FILTER (is_bot) AS VARCHAR), COUNT(*)
FROM pv GROUP BY b""",
    "top_products": """
SELECT product_id, action, CAST(SUM(event_count) AS BIGINT) AS total
FROM agg GROUP BY product_id, action
ORDER BY total DESC, product_id, action LIMIT 10""",
    "throughput": """
SELECT batch_ts, total_events, legit_events, flagged_events FROM metrics ORDER BY batch_ts""",
    "flagged_pct": """
SELECT CAST(SUM(legit_events) AS BIGINT) AS legit_total,
       CAST(SUM(flagged_events) AS BIGINT) AS flagged_total,
       ROUND(100.0 * CAST(SUM(flagged_events) AS DOUBLE)
             / NULLIF(CAST(SUM(total_events) AS DOUBLE), 0), 2) AS flagged_pct
FROM metrics""",
    "top_offenders": """
SELECT ip_address, COUNT(*) AS flagged_event_count, COUNT(DISTINCT batch_id) AS batches_flagged_in
FROM flagged GROUP BY ip_address
ORDER BY flagged_event_count DESC, ip_address LIMIT 10""",
    "latency_distribution": """
SELECT MIN(processing_time_ms) AS min_ms, ROUND(AVG(processing_time_ms), 1) AS avg_ms,
       MAX(processing_time_ms) AS max_ms, COUNT(*) AS batch_count
FROM metrics""",
    "minute_rollup": """
SELECT date_trunc('minute', batch_ts) AS minute, CAST(SUM(total_events) AS BIGINT) AS events_in_minute
FROM metrics GROUP BY 1 ORDER BY 1""",
    "table_counts": """
SELECT 'events_clean' AS table_name, COUNT(*) AS row_count FROM clean
UNION ALL SELECT 'events_flagged', COUNT(*) FROM flagged
UNION ALL SELECT 'events_agg', COUNT(*) FROM agg
UNION ALL SELECT 'pipeline_metrics', COUNT(*) FROM metrics""",
    "latest_batches": """
SELECT batch_id, batch_ts, total_events, legit_events, flagged_events, processing_time_ms
FROM metrics ORDER BY batch_ts DESC, batch_id DESC LIMIT 5""",
    "latency_series": """
SELECT batch_ts AS time, processing_time_ms AS ms FROM metrics ORDER BY batch_ts""",
    "flagged_ip_series": """
SELECT batch_ts AS time, distinct_flagged_ips AS bot_ips, distinct_ips AS total_ips
FROM metrics ORDER BY batch_ts""",
    "message_rate": """
SELECT date_trunc('minute', event_ts) AS window_start,
       date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end,
       COUNT(*) AS messages, CAST(COUNT(*) AS DOUBLE) / CAST(60 AS DOUBLE) AS rate_per_sec
FROM ev GROUP BY 1, 2""",
    "shard_distribution": r"""
SELECT table_name, 'node_' || CAST(shard % 3 AS VARCHAR) AS nodename, COUNT(*) AS shard_count,
       CAST(SUM(rows) AS BIGINT) AS row_count
FROM (
  SELECT 'events_clean' AS table_name,
         CAST('0x' || substr(md5(product_id), 1, 8) AS BIGINT) % 32 AS shard, COUNT(*) AS rows
  FROM clean GROUP BY 1, 2
  UNION ALL
  SELECT 'events_flagged', CAST('0x' || substr(md5(ip_address), 1, 8) AS BIGINT) % 32, COUNT(*)
  FROM flagged GROUP BY 1, 2
  UNION ALL
  SELECT 'events_agg', CAST('0x' || substr(md5(product_id), 1, 8) AS BIGINT) % 32, COUNT(*)
  FROM agg GROUP BY 1, 2
) s
GROUP BY 1, 2""",
    "reconcile_counts": """
SELECT COALESCE(b.batch_id, a.batch_id) AS batch_id,
       COALESCE(b.before_rows, 0) AS before_rows, COALESCE(a.after_rows, 0) AS after_rows,
       COALESCE(a.after_rows, 0) - COALESCE(b.before_rows, 0) AS diff
FROM (SELECT batch_id, COUNT(*) AS before_rows FROM ev GROUP BY batch_id) b
FULL OUTER JOIN (
  SELECT batch_id, COUNT(*) AS after_rows
  FROM (SELECT batch_id FROM clean UNION ALL SELECT batch_id FROM flagged) u GROUP BY batch_id
) a ON b.batch_id = a.batch_id""",
    "detection_accuracy": """
SELECT tp, fp, fn, tn,
       ROUND(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fp AS DOUBLE), 0), 4) AS precision,
       ROUND(CAST(tp AS DOUBLE) / NULLIF(CAST(tp + fn AS DOUBLE), 0), 4) AS recall,
       ROUND(CAST(fp AS DOUBLE) / NULLIF(CAST(fp + tn AS DOUBLE), 0), 4) AS fp_rate
FROM (
  SELECT CAST(SUM(CASE WHEN is_bot AND label THEN m ELSE 0 END) AS BIGINT) AS tp,
         CAST(SUM(CASE WHEN is_bot AND NOT label THEN m ELSE 0 END) AS BIGINT) AS fp,
         CAST(SUM(CASE WHEN NOT is_bot AND label THEN m ELSE 0 END) AS BIGINT) AS fn,
         CAST(SUM(CASE WHEN NOT is_bot AND NOT label THEN m ELSE 0 END) AS BIGINT) AS tn
  FROM (SELECT batch_id, ip_address, src_user % 15 = 0 AS label, COUNT(*) AS m
        FROM ev GROUP BY 1, 2, 3) l
  JOIN rt ON l.batch_id = rt.batch_id AND l.ip_address = rt.ip_address
) c""",
    "rate_conformance": f"""
SELECT phase_id, start_ts, expected, actual, rel_error, rel_error <= 0.01 AS within_tol
FROM (
  SELECT *, CASE WHEN expected = 0 THEN 0 ELSE abs(actual - expected) / expected END AS rel_error
  FROM (
    SELECT phase_id, start_ts, actual, (SUM(actual) OVER () / SUM(86400.0::DOUBLE) OVER ()) * 86400 AS expected
    FROM (
      SELECT ph.phase_id, ph.start_ts, COUNT(ev.event_id) AS actual
      FROM (SELECT i AS phase_id, CAST(DATE '2024-01-01' + CAST(i AS INTEGER) AS TIMESTAMP)
                     + INTERVAL {PHASE_OFFSET_MS} MILLISECOND AS start_ts
            FROM (SELECT unnest(range(min(batch_id), max(batch_id) + 1)) AS i FROM ev) days) ph
      LEFT JOIN ev ON ev.event_ts >= ph.start_ts AND ev.event_ts < ph.start_ts + INTERVAL 1 DAY
      GROUP BY ph.phase_id, ph.start_ts
    ) p
  ) q
) r""",
    "action_mix": """
SELECT traffic_class, action, n, ROUND(CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY traffic_class), 4) AS share,
       CAST(CASE WHEN traffic_class = 'normal' AND upper(action) = 'VIEW' THEN 0.7
            WHEN traffic_class = 'normal' AND upper(action) = 'ADD_TO_CART' THEN 0.2
            WHEN traffic_class = 'normal' AND upper(action) = 'PURCHASE' THEN 0.1
            WHEN traffic_class = 'bot' AND upper(action) = 'VIEW' THEN 0.1
            WHEN traffic_class = 'bot' AND upper(action) = 'ADD_TO_CART' THEN 0.2
            WHEN traffic_class = 'bot' AND upper(action) = 'PURCHASE' THEN 0.7 END AS DOUBLE) AS expected_share
FROM (SELECT CASE WHEN src_user % 15 = 0 THEN 'bot' ELSE 'normal' END AS traffic_class, action,
             COUNT(*) AS n FROM ev GROUP BY 1, 2) c""",
    "dead_letters": f"""
, sent AS (
  SELECT batch_id // {DEAD_LETTER_DAYS} AS b, CASE src_id % 100 {" ".join(f"WHEN {k} THEN '{c}'" for k, c in MISSING_FIELDS.items())} END AS error
  FROM ev)
SELECT b AS batch_id, error, COUNT(*) AS messages, CASE WHEN error IS NULL THEN 0 ELSE COUNT(*) END AS with_raw FROM sent GROUP BY 1, 2""",
    "distinct_ips": """
SELECT batch_id // 7 AS range, COUNT(DISTINCT ip_address) AS distinct_ips, true AS estimate_near FROM ev GROUP BY 1
UNION ALL SELECT -1, COUNT(DISTINCT ip_address), true FROM ev""",
    "wait_quantiles": """
SELECT batch_id // 7 AS range, quantile_disc(wait_ms, 0.5) AS p50_ms, quantile_disc(wait_ms, 0.95) AS p95_ms,
       quantile_disc(wait_ms, 0.99) AS p99_ms, true AS near_p50_ms, true AS near_p95_ms, true AS near_p99_ms
FROM (SELECT ev.batch_id, (epoch_us(max_ts) - epoch_us(event_ts)) // 1000 AS wait_ms FROM ev JOIN bs ON ev.batch_id = bs.batch_id) w
GROUP BY 1""",
    "heavy_hitters": """
SELECT ip_address, COUNT(*) AS events, COUNT(DISTINCT batch_id) AS batches FROM ev GROUP BY 1 ORDER BY events DESC, ip_address LIMIT 10""",
    "written_rows": f"""
, run AS (
  SELECT b, is_bot, COUNT(*) AS n, MIN(event_ts) AS first_event, MAX(event_ts) AS last_event FROM (
    SELECT ev.batch_id // {DEAD_LETTER_DAYS} AS b, event_ts, COUNT(*) OVER (PARTITION BY ev.batch_id // {DEAD_LETTER_DAYS}, ip_address)
      > CAST({float(WRITTEN_CONFIG.rate_per_sec)!r} AS DOUBLE) * ((MAX(epoch_us(event_ts)) OVER (PARTITION BY ev.batch_id // {DEAD_LETTER_DAYS})
      - MIN(epoch_us(event_ts)) OVER (PARTITION BY ev.batch_id // {DEAD_LETTER_DAYS})) / 1e6) AS is_bot
    FROM ev) x GROUP BY 1, 2)
SELECT b AS batch_id, CASE WHEN is_bot THEN 'events_flagged' ELSE 'events_clean' END AS table_name, coalesce(n, 0) AS written_rows,
       first_event, last_event, coalesce(n, 0) AS stored_rows, true AS same
FROM (SELECT DISTINCT b FROM run) CROSS JOIN (SELECT unnest([true, false]) AS is_bot) LEFT JOIN run USING (b, is_bot)""",
    "stored_answers": """
SELECT 'top_products' AS question, product_id AS k0, action AS k1, total AS n0, CAST(NULL AS BIGINT) AS n1, CAST(NULL AS BIGINT) AS n2
FROM (SELECT product_id, action, CAST(SUM(event_count) AS BIGINT) AS total FROM agg GROUP BY 1, 2 ORDER BY total DESC, product_id, action LIMIT 10)
UNION ALL SELECT 'throughput', strftime(batch_ts, '%Y-%m-%d %H:%M:%S'), NULL, total_events, legit_events, flagged_events FROM metrics
UNION ALL SELECT 'flagged_pct', NULL, NULL, CAST(SUM(legit_events) AS BIGINT), CAST(SUM(flagged_events) AS BIGINT), NULL FROM metrics
UNION ALL SELECT 'top_offenders', ip_address, NULL, n, b, NULL
FROM (SELECT ip_address, COUNT(*) AS n, COUNT(DISTINCT batch_id) AS b FROM flagged GROUP BY 1 ORDER BY n DESC, ip_address LIMIT 10)
UNION ALL SELECT 'latency_distribution', NULL, NULL, MIN(processing_time_ms), MAX(processing_time_ms), COUNT(*) FROM metrics
UNION ALL SELECT 'minute_rollup', strftime(date_trunc('minute', batch_ts), '%Y-%m-%d %H:%M:%S'), NULL, CAST(SUM(total_events) AS BIGINT), NULL, NULL
FROM metrics GROUP BY 2
UNION ALL SELECT 'table_counts', 'events_clean', NULL, COUNT(*), NULL, NULL FROM clean
UNION ALL SELECT 'table_counts', 'events_flagged', NULL, COUNT(*), NULL, NULL FROM flagged
UNION ALL SELECT 'table_counts', 'events_agg', NULL, COUNT(*), NULL, NULL FROM agg
UNION ALL SELECT 'table_counts', 'pipeline_metrics', NULL, COUNT(*), NULL, NULL FROM metrics
UNION ALL SELECT 'latest_batches', strftime(batch_ts, '%Y-%m-%d %H:%M:%S'), NULL, batch_id, total_events, processing_time_ms
FROM (SELECT * FROM metrics ORDER BY batch_ts DESC, batch_id DESC LIMIT 5)""",
    "window_verdicts": f"""
SELECT window_start, window_end, ip_address, n, threshold, is_bot, CASE WHEN is_bot THEN '{WINDOW_REASON}' END AS reason FROM wv""",
    "window_metrics": """
SELECT window_start, window_end, CAST(SUM(n) AS BIGINT) AS total_events,
       CAST(SUM(CASE WHEN is_bot THEN 0 ELSE n END) AS BIGINT) AS legit_events,
       CAST(SUM(CASE WHEN is_bot THEN n ELSE 0 END) AS BIGINT) AS flagged_events,
       COUNT(*) AS distinct_ips, COUNT(CASE WHEN is_bot THEN 1 END) AS distinct_flagged_ips
FROM wv GROUP BY 1, 2""",
    "window_detector": f"""
SELECT window_start, window_end, ip_address, n, threshold, is_bot, CASE WHEN is_bot THEN '{WINDOW_REASON}' END AS reason
FROM wv WHERE window_end <= (SELECT MAX(event_ts) - INTERVAL 1 MINUTE FROM ev)""",
    "late_rows": f"""
, arr AS (
  SELECT *, batch_id // {PIPELINE_DAYS} + CASE src_id % 40 {" ".join(f"WHEN {k} THEN {v}" for k, v in ARRIVAL_DELAYS.items())} ELSE 0 END AS run FROM ev),
marks AS (
  SELECT run, row_number() OVER (ORDER BY run) - 1 AS b,
         max(latest) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {LATE_DELAY_SECONDS * 1_000_000} AS watermark
  FROM (SELECT run, max(epoch_us(event_ts)) AS latest FROM arr GROUP BY run)),
seen AS (
  SELECT event_id, b, watermark - epoch_us(event_ts) AS behind_us,
         coalesce((epoch_us(event_ts) // {WINDOW_SECONDS * 1_000_000} + 1) * {WINDOW_SECONDS * 1_000_000} <= watermark, false) AS late
  FROM arr JOIN marks USING (run))
SELECT 'batch' AS kind, CAST(b AS BIGINT) AS batch_id, CAST(NULL AS VARCHAR) AS event_id, COUNT(*) AS input_rows,
       COUNT(*) FILTER (NOT late) AS on_time_rows, COUNT(*) FILTER (late) AS late_rows, CAST(NULL AS BIGINT) AS behind_us
FROM seen GROUP BY b
UNION ALL SELECT 'late', CAST(b AS BIGINT), event_id, NULL, NULL, NULL, behind_us FROM seen WHERE late""",
    "trailing_rate": f"""
, seen AS (
  SELECT i AS sample, COUNT(*) AS n FROM (
    SELECT unnest(range(CAST(ceil(epoch_us(event_ts) / {SAMPLE_SECONDS * 1e6}) AS BIGINT),
                        CAST(ceil((epoch_us(event_ts) + {TRAILING_SECONDS * 1_000_000}) / {SAMPLE_SECONDS * 1e6}) AS BIGINT))) AS i FROM ev)
  GROUP BY i),
grid AS (
  SELECT unnest(range((SELECT min(sample) FROM seen), (SELECT max(sample) FROM seen) + 2)) AS sample)
SELECT make_timestamp(sample * {SAMPLE_SECONDS * 1_000_000}) AS sample_ts, coalesce(n, 0) AS messages,
       CAST(coalesce(n, 0) AS DOUBLE) / {float(TRAILING_SECONDS)} AS rate_per_sec
FROM grid LEFT JOIN seen USING (sample)""",
    "product_activity": """
SELECT coalesce(c.product_id, a.product_id) AS product_id, clean_rows, last_event, agg_events, agg_keys,
       clean_rows IS NOT DISTINCT FROM agg_events AS balanced
FROM (SELECT product_id, COUNT(*) AS clean_rows, MAX(event_ts) AS last_event FROM clean GROUP BY product_id) c
FULL OUTER JOIN (SELECT product_id, CAST(SUM(event_count) AS BIGINT) AS agg_events, COUNT(*) AS agg_keys FROM agg GROUP BY product_id) a
  ON c.product_id = a.product_id""",
    "bucket_placement": """
SELECT 'events_clean' AS table_name, COUNT(*) AS row_count, CAST(0 AS BIGINT) AS misplaced_rows FROM clean
UNION ALL SELECT 'events_flagged', COUNT(*), 0 FROM flagged
UNION ALL SELECT 'events_agg', COUNT(*), 0 FROM agg""",
    "reconcile_content": f"""
, altered AS (
  SELECT event_id, user_id, CASE WHEN src_id % {ALTERED_MODULUS} = {ALTERED} THEN 'altered' ELSE action END AS action,
         product_id, ip_address, event_ts, batch_id FROM ev),
plain AS (SELECT event_id, user_id, action, product_id, ip_address, event_ts, batch_id FROM ev),
gone AS (SELECT batch_id, COUNT(*) AS n FROM (SELECT * FROM plain EXCEPT ALL SELECT * FROM altered) GROUP BY 1),
come AS (SELECT batch_id, COUNT(*) AS n FROM (SELECT * FROM altered EXCEPT ALL SELECT * FROM plain) GROUP BY 1)
SELECT e.batch_id, n_rows AS before_rows, n_rows AS after_rows, gone.n IS NULL AS same,
       coalesce(gone.n, 0) + coalesce(come.n, 0) AS differing_rows
FROM (SELECT batch_id, COUNT(*) AS n_rows FROM ev GROUP BY 1) e LEFT JOIN gone ON gone.batch_id = e.batch_id
LEFT JOIN come ON come.batch_id = e.batch_id""",
}


def oracle_sql() -> dict[str, str]:
    """A key's text goes on with further CTEs where it begins with a comma."""
    return {k: f"WITH {BASE.rstrip()}\n{v.strip()}" for k, v in FINAL.items()}
