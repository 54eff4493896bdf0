"""DuckDB oracle for the monitoring queries.  Sliding windows are spelled out
as five 1-minute-aligned starts per event; bucket quantiles follow the
Prometheus ``histogram_quantile`` definition."""

from __future__ import annotations

from tickloom.plans.rounding import round_sql

# Histogram bucket upper bounds.
BK = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)

LOG = """log AS (SELECT event_id, ts, event_type AS endpoint,
                CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
                value / 100.0 AS duration, CAST(user_id AS VARCHAR) AS portfolio_id FROM events)"""


def _le(b):
    return repr(float(b))


def _hist_cols(v="duration"):
    cols = [f"CAST(sum(CASE WHEN {v} <= {b!r} THEN 1 ELSE 0 END) AS BIGINT) AS le_{i}" for i, b in enumerate(BK)]
    cols.append(f"count({v}) AS le_inf")
    cols.append(f"sum({v}) AS value_sum")
    return ", ".join(cols)


def _quantile(q):
    parts = []
    prev_le, prev_cum = "0.0", "0"
    for i, b in enumerate(BK):
        cum = f"le_{i}"
        num = f"({q!r} * le_inf - {prev_cum})"
        den = f"({cum} - {prev_cum})"
        parts.append(f"WHEN {cum} >= {q!r} * le_inf THEN {prev_le} + ({b!r} - {prev_le}) * "
                     f"(CASE WHEN {den} = 0 THEN NULL ELSE {num} / {den} END)")
        prev_le, prev_cum = repr(float(b)), cum
    return f"CASE WHEN le_inf > 0 THEN (CASE {' '.join(parts)} ELSE {float(BK[-1])!r} END) END"


def q_api_counters():
    inner = f"""WITH {LOG} SELECT endpoint, status, count(*) AS requests,
  CAST(sum(CASE WHEN status >= 500 THEN 1 ELSE 0 END) AS BIGINT) AS errors, sum(duration) AS duration_sum
FROM log GROUP BY endpoint, status"""
    return round_sql(inner, ["endpoint", "status", "requests", "errors", "duration_sum"], {"duration_sum"})


def q_latency_histogram():
    unions = " UNION ALL ".join(
        [f"SELECT endpoint, '{_le(b)}' AS le, le_{i} AS cumulative_count, le_inf AS count, value_sum AS sum FROM h"
         for i, b in enumerate(BK)] +
        ["SELECT endpoint, '+Inf' AS le, le_inf AS cumulative_count, le_inf AS count, value_sum AS sum FROM h"])
    inner = f"""WITH {LOG}, h AS (SELECT endpoint, {_hist_cols()} FROM log GROUP BY endpoint) {unions}"""
    return round_sql(inner, ["endpoint", "le", "cumulative_count", "count", "sum"], {"sum"})


SLIDE = f"""{LOG},
sw AS (SELECT l.*, time_bucket(INTERVAL 1 MINUTE, ts) - k.k * INTERVAL 1 MINUTE AS window_start
       FROM log l CROSS JOIN (SELECT range AS k FROM range(0, 5)) k),
g AS (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, endpoint, count(*) AS requests,
             CAST(sum(CASE WHEN status >= 500 THEN 1 ELSE 0 END) AS BIGINT) AS errors, {_hist_cols()}
      FROM sw GROUP BY window_start, endpoint),
rates AS (SELECT window_start, window_end, endpoint, requests, errors, requests / 300.0 AS request_rate,
             errors / 300.0 AS error_rate,
             CASE WHEN requests = 0 THEN NULL ELSE errors / requests END * 100 AS error_pct,
             {_quantile(0.5)} AS p50_latency, {_quantile(0.95)} AS p95_latency
          FROM g)"""
RATE_COLS = ["window_start", "window_end", "endpoint", "requests", "errors", "request_rate", "error_rate",
             "error_pct", "p50_latency", "p95_latency"]


def q_request_rates():
    return round_sql(f"WITH {SLIDE} SELECT * FROM rates", RATE_COLS,
                     {"request_rate", "error_rate", "error_pct", "p50_latency", "p95_latency"})


def q_error_ratio():
    inner = f"""WITH {LOG} SELECT endpoint, count(*) AS requests,
  CAST(sum(CASE WHEN regexp_matches(CAST(status AS VARCHAR), '^5') THEN 1 ELSE 0 END) AS BIGINT) AS errors_5xx,
  CAST(sum(CASE WHEN regexp_matches(CAST(status AS VARCHAR), '^[45]') THEN 1 ELSE 0 END) AS BIGINT) AS errors_4xx_5xx,
  CASE WHEN count(*) = 0 THEN NULL ELSE sum(CASE WHEN status >= 500 THEN 1 ELSE 0 END) / count(*) END * 100 AS error_pct
FROM log GROUP BY endpoint"""
    return round_sql(inner, ["endpoint", "requests", "errors_5xx", "errors_4xx_5xx", "error_pct"], {"error_pct"})


def q_gauges():
    inner = f"""WITH {LOG} SELECT endpoint, portfolio_id,
  arg_max(duration, struct_pack(ts := ts, event_id := event_id)) AS last_value, max(ts) AS last_ts
FROM log GROUP BY endpoint, portfolio_id"""
    return round_sql(inner, ["endpoint", "portfolio_id", "last_value", "last_ts"], {"last_value"})


def q_model_health():
    inner = f"""WITH {LOG}, g AS (SELECT endpoint, arg_max(status, struct_pack(ts := ts, event_id := event_id)) AS last_status,
  max(ts) AS last_ts FROM log GROUP BY endpoint)
SELECT endpoint, last_status, last_ts, CASE WHEN last_status < 500 THEN 'healthy' ELSE 'unhealthy' END AS state,
  CASE WHEN last_status < 500 THEN 1.0 ELSE 0.0 END AS health FROM g"""
    return round_sql(inner, ["endpoint", "last_status", "last_ts", "state", "health"], {"health"})


def q_average_gauge():
    inner = f"""WITH {LOG}, g AS (SELECT endpoint, avg(duration) AS avg_value FROM log GROUP BY endpoint)
SELECT endpoint, avg_value, CASE WHEN avg_value >= 0.5 THEN 'red' WHEN avg_value >= 0.1 THEN 'yellow'
  ELSE 'green' END AS band FROM g"""
    return round_sql(inner, ["endpoint", "avg_value", "band"], {"avg_value"})


def q_metrics_summary():
    inner = f"""WITH {LOG} SELECT count(*) AS total_requests,
  CAST(sum(CASE WHEN status >= 500 THEN 1 ELSE 0 END) AS BIGINT) AS total_errors, avg(duration) AS avg_duration,
  count(DISTINCT endpoint) AS n_endpoints, count(DISTINCT portfolio_id) AS n_portfolios,
  CAST(floor(epoch(max(ts))) AS BIGINT) - CAST(floor(epoch(min(ts))) AS BIGINT) AS uptime_seconds FROM log"""
    return round_sql(inner, ["total_requests", "total_errors", "avg_duration", "n_endpoints", "n_portfolios",
                             "uptime_seconds"], {"avg_duration"})


def q_api_alerts():
    inner = f"""WITH {SLIDE},
samples AS (SELECT window_end AS ts, endpoint, 'error_rate' AS metric, error_rate AS value FROM rates
            UNION ALL SELECT window_end, endpoint, 'p95_latency', p95_latency FROM rates),
rules AS (SELECT * FROM (VALUES ('HighAPIErrorRate', 'error_rate', '>', 0.1, 120, 'warning'),
                                 ('HighAPILatency', 'p95_latency', '>', 2.0, 180, 'warning'))
          AS t(alert, metric, op, threshold, for_seconds, severity)),
b AS (SELECT r.alert, s.endpoint, s.ts, s.value, r.for_seconds, r.severity
      FROM samples s JOIN rules r ON s.metric = r.metric
      WHERE (r.op = '>' AND s.value > r.threshold) OR (r.op = '<' AND s.value < r.threshold)),
i AS (SELECT *, sum(CASE WHEN prev IS NULL OR epoch(ts) - epoch(prev) > 60 THEN 1 ELSE 0 END)
                OVER (PARTITION BY alert, endpoint ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
      FROM (SELECT *, lag(ts) OVER (PARTITION BY alert, endpoint ORDER BY ts) AS prev FROM b)),
ga AS (SELECT alert, endpoint, island, min(ts) AS since, max(ts) AS until, count(*) AS evaluations,
             max(value) AS peak_value, first(severity) AS severity, first(for_seconds) AS for_seconds
      FROM i GROUP BY alert, endpoint, island)
SELECT alert, endpoint, since, until, evaluations, peak_value, severity,
  CAST(floor(epoch(until)) - floor(epoch(since)) AS BIGINT) AS held_seconds,
  CASE WHEN floor(epoch(until)) - floor(epoch(since)) >= for_seconds THEN 'firing' ELSE 'pending' END AS state
FROM ga"""
    cols = ["alert", "endpoint", "since", "until", "evaluations", "peak_value", "severity", "held_seconds", "state"]
    return round_sql(inner, cols, {"peak_value"})


def q_up_down():
    inner = f"""WITH {LOG}, n AS (SELECT endpoint, ts, lead(ts) OVER (PARTITION BY endpoint ORDER BY ts, event_id) AS next_ts FROM log)
SELECT endpoint, ts AS down_from, next_ts AS down_until,
  CAST(floor(epoch(next_ts)) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) AS gap_seconds
FROM n WHERE CAST(floor(epoch(next_ts)) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) > 3600"""
    return round_sql(inner, ["endpoint", "down_from", "down_until", "gap_seconds"], set())


ORACLE = {
    "api_counters": q_api_counters,
    "latency_histogram": q_latency_histogram,
    "request_rates": q_request_rates,
    "error_ratio": q_error_ratio,
    "gauges": q_gauges,
    "model_health": q_model_health,
    "average_gauge": q_average_gauge,
    "metrics_summary": q_metrics_summary,
    "api_alerts": q_api_alerts,
    "up_down": q_up_down,
}
