"""DuckDB oracle for the store, join, source, message and alert queries.
Trailing windows are counted from the raw events per evaluated minute."""

from __future__ import annotations

from tickloom.plans.contracts import digits
from tickloom.plans.oracle import TICKS
from tickloom.plans.oracle_market import BRAND, _bt
from tickloom.plans.oracle_monitoring import LOG
from tickloom.plans.oracle_ops import REG, TLOG
from tickloom.plans.rounding import round_sql

# Histogram bucket upper bounds.
PREDICTION_BK = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0)
CONFIDENCE_BK = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 1.0)

SYSTEM = """sl AS (SELECT event_id, ts, 'm' || CAST(event_id % 3 AS VARCHAR) AS model, value / 100.0 AS duration,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, 100.0 / (100.0 + value) AS confidence,
  value / 100.0 AS memory_gb, CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS cost,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS rebalanced FROM events)"""


def _histogram(value, bounds):
    rows = [f"SELECT model, '{float(b)!r}' AS le, count(*) FILTER (WHERE {value} <= {b!r}) AS cumulative_count, "
            f"count({value}) AS count, sum({value}) AS sum FROM sl GROUP BY model" for b in bounds]
    rows.append(f"SELECT model, '+Inf', count({value}), count({value}), sum({value}) FROM sl GROUP BY model")
    return round_sql(f"WITH {SYSTEM} {' UNION ALL '.join(rows)}", ["model", "le", "cumulative_count", "count", "sum"],
                     {"sum"})


def q_prediction_histogram():
    return _histogram("duration", PREDICTION_BK)


def q_confidence_histogram():
    return _histogram("confidence", CONFIDENCE_BK)


def q_rate_windows():
    cols, rates = ["window_end", "endpoint"], set()
    sel = []
    for name, s in (("1m", 60), ("5m", 300), ("10m", 600), ("30m", 1800), ("1h", 3600)):
        inside = f"FILTER (WHERE l.ts >= e.window_end - INTERVAL {s} SECOND"
        sel += [f"count(*) {inside}) AS increase_{name}", f"count(*) {inside}) / {s}.0 AS rate_{name}",
                f"count(*) {inside} AND l.status >= 500) / {s}.0 AS error_rate_{name}"]
        cols += [f"increase_{name}", f"rate_{name}", f"error_rate_{name}"]
        rates |= {f"rate_{name}", f"error_rate_{name}"}
    inner = f"""WITH {LOG},
e AS (SELECT DISTINCT endpoint, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end FROM log)
SELECT e.window_end, e.endpoint, {', '.join(sel)}
FROM e JOIN log l ON l.endpoint = e.endpoint AND l.ts < e.window_end AND l.ts >= e.window_end - INTERVAL 1 HOUR
GROUP BY e.window_end, e.endpoint"""
    return round_sql(inner, cols, rates)


def _bucket_quantile(q, value, bounds, seconds):
    """Bucket quantile of the joined events of the last ``seconds``."""
    inside = f"l.ts >= e.ts - INTERVAL {seconds} SECOND"
    total = f"count({value}) FILTER (WHERE {inside})"
    low, below, parts = "0.0", "0", []
    for b in bounds:
        cum = f"count(*) FILTER (WHERE {inside} AND {value} <= {b!r})"
        parts.append(f"WHEN {cum} >= {q!r} * {total} THEN {low} + ({b!r} - {low}) * "
                     f"(CASE WHEN {cum} - {below} = 0 THEN NULL ELSE ({q!r} * {total} - {below}) / ({cum} - {below}) END)")
        low, below = repr(float(b)), cum
    return f"CASE WHEN {total} > 0 THEN (CASE {' '.join(parts)} ELSE {float(bounds[-1])!r} END) END"


def _alerts(label, step_seconds, rules):
    """Islands of consecutive breaches of ``samples(ts, label, metric, value)``."""
    values = ", ".join(str(r) for r in rules)
    return f"""rules AS (SELECT * FROM (VALUES {values}) AS t(alert, metric, op, threshold, for_seconds, severity)),
b AS (SELECT r.alert, s.{label}, s.ts, s.value, r.op, r.for_seconds, r.severity FROM samples s JOIN rules r ON s.metric = r.metric
      WHERE s.value IS NOT NULL AND CASE r.op WHEN '>' THEN s.value > r.threshold ELSE s.value < r.threshold END),
i AS (SELECT *, sum(CASE WHEN prev IS NULL OR epoch(ts) - epoch(prev) > {step_seconds} THEN 1 ELSE 0 END)
        OVER (PARTITION BY alert, {label} ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
      FROM (SELECT *, lag(ts) OVER (PARTITION BY alert, {label} ORDER BY ts) AS prev FROM b)),
ga AS (SELECT alert, {label}, min(ts) AS since, max(ts) AS until, count(*) AS evaluations,
         CASE WHEN any_value(op) = '<' THEN min(value) ELSE max(value) END AS peak_value,
         any_value(severity) AS severity, any_value(for_seconds) AS for_seconds FROM i GROUP BY alert, {label}, island)
SELECT alert, {label}, since, until, evaluations, peak_value, severity,
  CAST(epoch(until) - epoch(since) AS BIGINT) AS held_seconds,
  CASE WHEN epoch(until) - epoch(since) >= for_seconds THEN 'firing' ELSE 'pending' END AS state FROM ga"""


def _alert_cols(label):
    return ["alert", label, "since", "until", "evaluations", "peak_value", "severity", "held_seconds", "state"]


def q_system_alerts():
    hour = "l.ts >= e.ts - INTERVAL 3600 SECOND"
    half = "l.ts >= e.ts - INTERVAL 1800 SECOND"
    newest = "struct_pack(ts := l.ts, event_id := l.event_id)"
    metrics = {
        "model_health": f"CASE WHEN arg_max(l.status, {newest}) < 500 THEN 1.0 ELSE 0.0 END",
        "p95_prediction_latency": _bucket_quantile(0.95, "l.duration", PREDICTION_BK, 600),
        "median_confidence": _bucket_quantile(0.5, "l.confidence", CONFIDENCE_BK, 1800),
        "memory_gb": f"arg_max(l.memory_gb, {newest})",
        "failed_run_ratio": f"count(*) FILTER (WHERE {half} AND l.status >= 500) / count(*) FILTER (WHERE {half})",
        "transaction_cost_increase_1h": f"sum(l.cost) FILTER (WHERE {hour})",
        "rebalances_per_hour": f"sum(l.rebalanced) FILTER (WHERE {hour})",
    }
    rules = [("ModelUnhealthy", "model_health", "<", 1.0, 300, "critical"),
             ("SlowPredictions", "p95_prediction_latency", ">", 5.0, 300, "warning"),
             ("LowPredictionConfidence", "median_confidence", "<", 0.3, 600, "warning"),
             ("HighMemoryUsage", "memory_gb", ">", 2.0, 300, "warning"),
             ("CriticalMemoryUsage", "memory_gb", ">", 4.0, 120, "critical"),
             ("HighMLflowFailureRate", "failed_run_ratio", ">", 0.2, 300, "warning"),
             ("HighTransactionCosts", "transaction_cost_increase_1h", ">", 100.0, 60, "warning"),
             ("FrequentRebalancing", "rebalances_per_hour", ">", 10.0, 300, "warning")]
    wide = ", ".join(f"{v} AS {k}" for k, v in metrics.items())
    samples = " UNION ALL ".join(f"SELECT ts, model, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM wide" for m in metrics)
    inner = f"""WITH {SYSTEM},
e AS (SELECT DISTINCT model, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS ts FROM sl),
wide AS (SELECT e.ts, e.model, {wide} FROM e JOIN sl l ON l.model = e.model AND l.ts < e.ts AND {hour} GROUP BY e.ts, e.model),
samples AS ({samples}), {_alerts('model', 60, rules)}"""
    return round_sql(inner, _alert_cols("model"), {"peak_value"})


GAUGES = """gg AS (SELECT portfolio_id, step, value, ret * 100 AS return_percentage, (value / 10000.0 - 1) * 100 AS total_return_percentage,
  stddev_pop(ret) OVER w * sqrt(252) * 100 AS volatility_percentage, max(drawdown) OVER w * 100 AS max_drawdown_percentage,
  CASE WHEN stddev_pop(ret) OVER w * sqrt(252) > 1e-8
       THEN avg(ret) OVER w * 252 / (stddev_pop(ret) OVER w * sqrt(252)) END AS sharpe_ratio
  FROM res WINDOW w AS (PARTITION BY portfolio_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
GAUGE_COLS = ["portfolio_id", "step", "value", "return_percentage", "total_return_percentage", "volatility_percentage",
              "max_drawdown_percentage", "sharpe_ratio"]


def q_portfolio_gauges():
    return round_sql(_bt(f", {GAUGES} SELECT * FROM gg"), GAUGE_COLS, set(GAUGE_COLS[2:]), digits("portfolio_gauges"))


def q_portfolio_alerts():
    rules = [("HighDrawdown", "max_drawdown_percentage", ">", 15.0, 60, "warning"),
             ("CriticalDrawdown", "max_drawdown_percentage", ">", 25.0, 60, "critical"),
             ("HighVolatility", "volatility_percentage", ">", 30.0, 300, "warning"),
             ("LowSharpeRatio", "sharpe_ratio", "<", 0.5, 600, "warning")]
    samples = " UNION ALL ".join(
        f"SELECT CAST(c.date AS TIMESTAMP) AS ts, portfolio_id, '{m}' AS metric, {m} AS value FROM gg JOIN cal c ON c.step = gg.step"
        for m in ("max_drawdown_percentage", "volatility_percentage", "sharpe_ratio"))
    body = f", {GAUGES}, samples AS ({samples}), {_alerts('portfolio_id', 7 * 86400, rules)}"
    return round_sql(_bt(body), _alert_cols("portfolio_id"), {"peak_value"}, digits("portfolio_alerts"))


BT_LOG = """tl AS (SELECT portfolio_id AS run_id, step - 30 AS step, reward, ret, drawdown, value FROM res),
pr AS (SELECT * FROM (SELECT run_id, step, avg(reward) OVER w AS mean_reward, stddev_pop(reward) OVER w AS std_reward,
    reward AS last_reward, avg(ret * 100) OVER w AS mean_ret_pct, stddev_pop(ret * 100) OVER w AS std_ret_pct,
    avg(drawdown * 100) OVER w AS mean_drawdown_pct, avg(value) OVER w AS mean_value
  FROM tl WINDOW w AS (PARTITION BY run_id ORDER BY step ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
  WHERE step % 10 = 0 AND step > 5)"""


def q_backtest_training_progress():
    cols = ["run_id", "step", "mean_reward", "std_reward", "last_reward", "mean_ret_pct", "std_ret_pct",
            "mean_drawdown_pct", "mean_value"]
    return round_sql(_bt(f", {BT_LOG} SELECT * FROM pr"), cols, set(cols[2:]), digits("backtest_training_progress"))


def q_backtest_training_summary():
    cols = ["run_id", "n_steps", "first_reward", "final_reward", "total_reward", "first_value", "final_value",
            "best_reward", "total_return", "best_mean_reward"]
    body = f""", {BT_LOG},
s AS (SELECT run_id, count(*) AS n_steps, arg_min(reward, step) AS first_reward, arg_max(reward, step) AS final_reward,
        sum(reward) AS total_reward, arg_min(value, step) AS first_value, arg_max(value, step) AS final_value,
        max(reward) AS best_reward FROM tl GROUP BY run_id),
m AS (SELECT run_id, max(mean_reward) AS best_mean_reward FROM pr GROUP BY run_id)
SELECT s.*, (final_value / first_value - 1) * 100 AS total_return, m.best_mean_reward FROM s LEFT JOIN m ON m.run_id = s.run_id"""
    return round_sql(_bt(body), cols, set(cols[2:]), digits("backtest_training_summary"))


def q_trailing_failure_ratio():
    inner = """WITH sw AS (SELECT event_type, date_trunc('minute', ts) - k.k * INTERVAL 1 MINUTE AS window_start
  FROM events CROSS JOIN (SELECT range AS k FROM range(0, 30)) k),
g AS (SELECT window_start, count(*) AS runs, count(*) FILTER (WHERE event_type = 'error') AS failed FROM sw GROUP BY window_start)
SELECT window_start, runs, failed, failed / runs AS failure_ratio, failed / runs > 0.2 AS alert FROM g"""
    return round_sql(inner, ["window_start", "runs", "failed", "failure_ratio", "alert"], {"failure_ratio"})


def q_scored_requests():
    inner = f"""WITH {BRAND},
lastw AS (SELECT portfolio_id, max(step) AS step FROM wpos GROUP BY portfolio_id),
cur AS (SELECT w.portfolio_id, w.ticker, w.weight FROM wpos w JOIN lastw l ON w.portfolio_id = l.portfolio_id AND w.step = l.step),
l30 AS (SELECT * FROM (SELECT ticker, step, close, row_number() OVER (PARTITION BY ticker ORDER BY step DESC) AS k FROM panel) WHERE k <= 30),
rr AS (SELECT ticker, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY step), 0) - 1 AS r FROM l30),
vol AS (SELECT ticker, stddev_pop(r) AS v FROM rr GROUP BY ticker),
req AS (SELECT CAST(s_suppkey AS VARCHAR) AS portfolio_id, s_acctbal AS bal, s_nationkey / 20.0 AS risk,
          EXISTS (SELECT 1 FROM cur WHERE cur.portfolio_id = CAST(s_suppkey AS VARCHAR)) AS held FROM supplier),
chk AS (SELECT portfolio_id, CASE WHEN NOT held THEN 'market data must be 3-D' WHEN NOT bal > 0 THEN 'portfolio value must be positive'
          WHEN risk > 1 THEN 'risk tolerance outside [0, 1]' ELSE 'ok' END AS reason FROM req),
p AS (SELECT c.portfolio_id, c.ticker, c.weight, CASE WHEN v.v > 1e-8 THEN 1.0 / v.v ELSE 0.0 END AS raw
      FROM cur c LEFT JOIN vol v ON v.ticker = c.ticker),
q AS (SELECT portfolio_id, CAST(row_number() OVER (PARTITION BY portfolio_id ORDER BY ticker) - 1 AS INTEGER) AS asset, weight,
        raw, sum(raw) OVER (PARTITION BY portfolio_id) AS total FROM p)
SELECT k.portfolio_id, CASE WHEN k.reason = 'ok' THEN 'success' ELSE 'rejected' END AS status, k.reason, q.asset,
  q.weight AS current_weight, q.raw / q.total AS new_weight, q.raw / q.total - q.weight AS change
FROM chk k LEFT JOIN q ON q.portfolio_id = k.portfolio_id AND k.reason = 'ok'"""
    return round_sql(inner, ["portfolio_id", "status", "reason", "asset", "current_weight", "new_weight", "change"],
                     {"current_weight", "new_weight", "change"})


def q_common_dates():
    return f"""WITH {BRAND} SELECT date FROM bbars GROUP BY date
HAVING count(DISTINCT ticker) = (SELECT count(DISTINCT ticker) FROM bbars)"""


def q_missing_features():
    return """SELECT DISTINCT c_custkey AS feature FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate <= DATE '1995-12-31')"""


def q_runs_with_versions():
    inner = """SELECT o_orderkey AS run_id, o_orderstatus AS status, l_linenumber AS version, l_quantity AS metric
FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""
    return round_sql(inner, ["run_id", "status", "version", "metric"], {"metric"}, digits("runs_with_versions"))


def _ticks_between(low, high):
    inner = f"""WITH {TICKS} SELECT ticker, count(*) AS n_ticks, sum(volume) AS volume FROM ticks
WHERE date BETWEEN {low} AND {high} GROUP BY ticker"""
    return round_sql(inner, ["ticker", "n_ticks", "volume"], {"volume"})


def q_date_range_ticks():
    return _ticks_between("DATE '1996-01-01'", "DATE '1996-12-31'")


def q_lookback_ticks():
    return _ticks_between("DATE '1997-06-30' - 730", "DATE '1997-06-30'")


def q_merged_snapshots():
    inner = """SELECT user_id, event_type, ts, value FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events f WHERE f.user_id = e.user_id AND f.event_type = e.event_type AND f.ts > e.ts)"""
    return round_sql(inner, ["user_id", "event_type", "ts", "value"], {"value"})


def q_upserted_weights():
    inner = f"""WITH {BRAND},
u AS (SELECT portfolio_id, ticker, floor(weight * 8) / 8 AS weight, step FROM wpos),
ok AS (SELECT portfolio_id, step FROM u GROUP BY portfolio_id, step HAVING abs(sum(weight) - 1) <= 0.01),
newest AS (SELECT portfolio_id, max(step) AS step FROM wpos GROUP BY portfolio_id)
SELECT w.portfolio_id, w.ticker, CASE WHEN ok.step IS NULL THEN w.weight ELSE u.weight END AS weight, w.step AS updated_at
FROM wpos w JOIN newest n ON w.portfolio_id = n.portfolio_id AND w.step = n.step
LEFT JOIN ok ON ok.portfolio_id = w.portfolio_id AND ok.step = w.step
LEFT JOIN u ON u.portfolio_id = w.portfolio_id AND u.step = w.step AND u.ticker = w.ticker"""
    return round_sql(inner, ["portfolio_id", "ticker", "weight", "updated_at"], {"weight"})


def q_model_info():
    inner = f"""WITH {REG} SELECT model, version, stage, source, loaded_at, metric, source AS param_source FROM reg
WHERE model = '1-URGENT' ORDER BY loaded_at DESC, version DESC LIMIT 1"""
    return round_sql(inner, ["model", "version", "stage", "source", "loaded_at", "metric", "param_source"],
                     {"metric"}, digits("model_info"))


def q_run_report():
    inner = f"""WITH {TLOG},
s AS (SELECT run_id, count(*) AS n_steps, avg(reward / 100.0) AS avg_value,
             count(*) FILTER (WHERE event_type = 'error') AS errors_5xx FROM tl GROUP BY run_id),
b AS (SELECT run_id, max(mean_reward) AS best_mean_reward FROM pr GROUP BY run_id),
j AS (SELECT s.*, b.best_mean_reward, CASE WHEN avg_value >= 0.5 THEN 'red' WHEN avg_value >= 0.1 THEN 'yellow' ELSE 'green' END AS band
      FROM s LEFT JOIN b ON s.run_id = b.run_id)
SELECT *, band AS report_band, n_steps AS report_steps FROM j"""
    return round_sql(inner, ["run_id", "n_steps", "best_mean_reward", "avg_value", "band", "errors_5xx", "report_band",
                             "report_steps"], {"best_mean_reward", "avg_value"})


def q_parsed_messages():
    inner = """SELECT event_type AS ticker, 'real_time_stock_data' AS source_topic, count(*) AS n_ticks, sum(value) AS close_sum,
  min(date_trunc('second', ts)) AS first_ts, max(date_trunc('second', ts)) AS last_ts
FROM events WHERE event_type <> 'error' GROUP BY event_type"""
    return round_sql(inner, ["ticker", "source_topic", "n_ticks", "close_sum", "first_ts", "last_ts"], {"close_sum"})


def q_malformed_messages():
    return "SELECT event_id, event_type AS key, props AS value FROM events WHERE event_type = 'error'"


def q_stream_request_rates():
    inner = """WITH sw AS (SELECT event_type AS endpoint, date_trunc('minute', ts) - k.k * INTERVAL 1 MINUTE AS window_start
  FROM events CROSS JOIN (SELECT range AS k FROM range(0, 5)) k)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, endpoint, count(*) AS requests,
  count(*) FILTER (WHERE endpoint = 'error') AS errors, count(*) / 300.0 AS request_rate,
  count(*) FILTER (WHERE endpoint = 'error') / 300.0 AS error_rate FROM sw GROUP BY window_start, endpoint"""
    return round_sql(inner, ["window_start", "window_end", "endpoint", "requests", "errors", "request_rate", "error_rate"],
                     {"request_rate", "error_rate"})


ORACLE = {
    "rate_windows": q_rate_windows,
    "prediction_histogram": q_prediction_histogram,
    "confidence_histogram": q_confidence_histogram,
    "system_alerts": q_system_alerts,
    "portfolio_gauges": q_portfolio_gauges,
    "portfolio_alerts": q_portfolio_alerts,
    "backtest_training_progress": q_backtest_training_progress,
    "backtest_training_summary": q_backtest_training_summary,
    "trailing_failure_ratio": q_trailing_failure_ratio,
    "scored_requests": q_scored_requests,
    "common_dates": q_common_dates,
    "missing_features": q_missing_features,
    "runs_with_versions": q_runs_with_versions,
    "date_range_ticks": q_date_range_ticks,
    "lookback_ticks": q_lookback_ticks,
    "merged_snapshots": q_merged_snapshots,
    "upserted_weights": q_upserted_weights,
    "model_info": q_model_info,
    "run_report": q_run_report,
    "parsed_messages": q_parsed_messages,
    "malformed_messages": q_malformed_messages,
    "stream_request_rates": q_stream_request_rates,
}
