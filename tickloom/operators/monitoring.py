"""J1–J11 — monitoring analytics over a request/event log.

The log is a fact table; every metric is a grouped aggregate (partial
aggregation before the shuffle) or a window over a bounded per-label series.
Histogram buckets are a fixed list, so a histogram is ONE aggregate with one
conditional count per bound — no explode of the log.  Sliding and trailing
windows run over one-minute aggregates, never over the log.  Alert rules are a
fixed, tiny table joined to metric samples; the ``for`` clause is a
gaps-and-islands pass per (rule, labels).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.core import UNB, td

# Histogram bucket upper bounds (seconds / score), in order.
API_LATENCY_BUCKETS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
PREDICTION_LATENCY_BUCKETS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0)
CONFIDENCE_BUCKETS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 1.0)

# Alert rules that apply to request-log metrics
# (alert, metric, op, threshold, for_seconds, severity).
API_RULES = (
    ("HighAPIErrorRate", "error_rate", ">", 0.1, 120, "warning"),
    ("HighAPILatency", "p95_latency", ">", 2.0, 180, "warning"),
)
# The portfolio / system rules (same evaluator, other metrics).
PORTFOLIO_RULES = (
    ("ModelUnhealthy", "model_health", "<", 1.0, 300, "critical"),
    ("SlowPredictions", "p95_prediction_latency", ">", 5.0, 300, "warning"),
    ("LowPredictionConfidence", "median_confidence", "<", 0.3, 600, "warning"),
    ("HighDrawdown", "max_drawdown_percentage", ">", 15.0, 60, "warning"),
    ("CriticalDrawdown", "max_drawdown_percentage", ">", 25.0, 60, "critical"),
    ("HighVolatility", "volatility_percentage", ">", 30.0, 300, "warning"),
    ("LowSharpeRatio", "sharpe_ratio", "<", 0.5, 600, "warning"),
    ("HighMemoryUsage", "memory_gb", ">", 2.0, 300, "warning"),
    ("CriticalMemoryUsage", "memory_gb", ">", 4.0, 120, "critical"),
    ("HighMLflowFailureRate", "failed_run_ratio", ">", 0.2, 300, "warning"),
    ("HighTransactionCosts", "transaction_cost_increase_1h", ">", 100.0, 60, "warning"),
    ("FrequentRebalancing", "rebalances_per_hour", ">", 10.0, 300, "warning"),
)

# Rules on targets that report nothing, or zero
# (alert, for_seconds, severity).
UP_RULES = (
    ("APIDown", 60, "critical"),
    ("SystemDown", 60, "critical"),
    ("MLflowDown", 120, "warning"),
)
# Bands of the mean confidence.
CONFIDENCE_BANDS = ((0.8, "green"), (0.6, "yellow"))

RULE_SCHEMA = "alert string, metric string, op string, threshold double, for_seconds long, severity string"


def rules_frame(spark, rules=API_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


# ---------------------------------------------------------------- J1 counters
def counters(log: DataFrame, labels=("endpoint", "status")) -> DataFrame:
    """Totals per label set: requests, errors, summed duration."""
    return log.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.when(F.col("status") >= 500, 1).otherwise(0)).cast("long").alias("errors"),
        F.sum("duration").alias("duration_sum"))


def system_counters(log: DataFrame, model: str = "model", kind: str = "prediction_type",
                    portfolio: str = "portfolio_id", trigger: str = "trigger") -> DataFrame:
    """Predictions per (model, type), rebalancings per (portfolio, trigger) and
    transaction costs per portfolio, in one pass over the log: (metric, label,
    detail, total).  ``log`` has the four label columns, ``rebalanced`` and ``cost``."""
    one = F.lit(1.0)
    sets = log.groupingSets([[F.col(model), F.col(kind)], [F.col(portfolio), F.col(trigger)], [F.col(portfolio)]],
                            model, kind, portfolio, trigger)
    g = sets.agg(F.grouping_id().alias("_set"), F.sum(one).alias("n"), F.sum("rebalanced").cast("double").alias("rebalanced"),
                 F.sum("cost").alias("cost"))
    # grouping_id sets a bit for every label that is summed over.
    metric = F.when(F.col("_set") == 3, "predictions").when(F.col("_set") == 12, "rebalancing_events").otherwise("transaction_costs")
    total = F.when(F.col("_set") == 3, F.col("n")).when(F.col("_set") == 12, F.col("rebalanced")).otherwise(F.col("cost"))
    first = F.when(F.col("_set") == 3, F.col(model)).otherwise(F.col(portfolio))
    second = F.when(F.col("_set") == 3, F.col(kind)).when(F.col("_set") == 12, F.col(trigger))
    out = g.select(metric.alias("metric"), first.alias("label"), second.alias("detail"), total.alias("total"))
    return out.filter((F.col("metric") != "rebalancing_events") | (F.col("total") > 0))


# ---------------------------------------------------------------- J2 / J6 histograms
def _le_label(b: float) -> str:
    return repr(float(b))


def bucket_counts(value: Column, buckets, prefix: str = "le_") -> list[Column]:
    """Aggregate expressions: cumulative count per bound and +Inf."""
    cols = [F.sum(F.when(value <= b, 1).otherwise(0)).cast("long").alias(f"{prefix}{i}")
            for i, b in enumerate(buckets)]
    return [*cols, F.count(value).alias(f"{prefix}inf")]


def histogram_columns(value: Column, buckets) -> list[Column]:
    """Aggregate expressions: cumulative count per bound, +Inf, sum."""
    return [*bucket_counts(value, buckets), F.sum(value).alias("value_sum")]


def histogram(log: DataFrame, labels=("endpoint",), value: str = "duration",
              buckets=API_LATENCY_BUCKETS) -> DataFrame:
    """J2 long form: (labels…, le, cumulative_count, count, sum)."""
    g = log.groupBy(*labels).agg(*histogram_columns(F.col(value), buckets))
    entries = [F.struct(F.lit(_le_label(b)).alias("le"), F.col(f"le_{i}").alias("cum"))
               for i, b in enumerate(buckets)]
    entries.append(F.struct(F.lit("+Inf").alias("le"), F.col("le_inf").alias("cum")))
    return g.select(*labels, F.explode(F.array(*entries)).alias("_b"),
                    F.col("le_inf").alias("count"), F.col("value_sum").alias("sum")) \
        .select(*labels, "_b.le", F.col("_b.cum").alias("cumulative_count"), "count", "sum")


def quantile_from_buckets(q: float, buckets, prefix: str = "le_") -> Column:
    """Prometheus ``histogram_quantile`` over the cumulative columns
    produced by ``histogram_columns``: linear interpolation inside the first
    bucket whose cumulative count reaches q·total; the +Inf bucket returns the
    highest finite bound; no observations → NULL."""
    total = F.col(f"{prefix}inf")
    rank = F.lit(q) * total
    expr = None
    prev_le, prev_cum = 0.0, F.lit(0)
    branches = []
    for i, b in enumerate(buckets):
        cum = F.col(f"{prefix}{i}")
        val = F.lit(prev_le) + (F.lit(b) - F.lit(prev_le)) * td(rank - prev_cum, cum - prev_cum)
        branches.append((cum >= rank, val))
        prev_le, prev_cum = b, cum
    branches.append((F.lit(True), F.lit(float(buckets[-1]))))
    for cond, val in reversed(branches):
        expr = val if expr is None else F.when(cond, val).otherwise(expr)
    return F.when(total > 0, expr)


# ---------------------------------------------------------------- J5 / J7 rates
def per_minute(log: DataFrame, labels, aggregates, slide: str = "1 minute") -> DataFrame:
    """The log reduced to one row per (label set, bucket of ``slide``); the
    bucket's start is ``ts``.  Every aggregate must be a sum or a count, so that
    wider windows add the buckets up."""
    g = log.groupBy(F.window("ts", slide).alias("_m"), *labels).agg(*aggregates)
    return g.select(F.col("_m.start").alias("ts"), *[c for c in g.columns if c != "_m"])


def _requests() -> list[Column]:
    return [F.count(F.lit(1)).alias("requests"),
            F.sum(F.when(F.col("status") >= 500, 1).otherwise(0)).cast("long").alias("errors")]


def sliding_rates(log: DataFrame, width: str = "5 minutes", slide: str = "1 minute",
                  width_seconds: int = 300, labels=("endpoint",),
                  buckets=API_LATENCY_BUCKETS) -> DataFrame:
    """J5/J7 per sliding window: request and error rate per second (Σ/width,
    no extrapolation), error percentage and p50/p95 latency from buckets.
    ``width`` is a multiple of ``slide``."""
    per = per_minute(log, labels, [*_requests(), *bucket_counts(F.col("duration"), buckets)], slide)
    g = per.groupBy(F.window("ts", width, slide).alias("w"), *labels).agg(
        *[F.sum(c).alias(c) for c in per.columns if c not in ("ts", *labels)])
    return g.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *labels,
        "requests", "errors",
        (F.col("requests") / width_seconds).alias("request_rate"),
        (F.col("errors") / width_seconds).alias("error_rate"),
        (td("errors", "requests") * 100).alias("error_pct"),
        quantile_from_buckets(0.5, buckets).alias("p50_latency"),
        quantile_from_buckets(0.95, buckets).alias("p95_latency"))


# Look-back of the rates, in seconds.
RATE_WIDTHS = {"1m": 60, "5m": 300, "10m": 600, "30m": 1800, "1h": 3600}


def _trailing(labels, seconds: int):
    """Frame of the minutes that end within the last ``seconds``."""
    return Window.partitionBy(*labels).orderBy("_s").rangeBetween(60 - seconds, 0)


def rate_windows(log: DataFrame, labels=("endpoint",), widths=RATE_WIDTHS) -> DataFrame:
    """Increase and per-second rate of requests and errors over every
    look-back, evaluated at the end of every minute that has requests.  All
    look-backs share one sort of the one-minute aggregates."""
    per = per_minute(log, labels, _requests()).withColumn("_s", F.unix_timestamp("ts"))
    out = []
    for name, seconds in widths.items():
        n, e = (F.sum(c).over(_trailing(labels, seconds)) for c in ("requests", "errors"))
        out += [n.alias(f"increase_{name}"), (n / seconds).alias(f"rate_{name}"),
                (e / seconds).alias(f"error_rate_{name}")]
    return per.select((F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("window_end"), *labels, *out)


def error_ratio(log: DataFrame, labels=("endpoint",)) -> DataFrame:
    """Errors ÷ requests · 100 and the 4xx/5xx share per label set."""
    st = F.col("status").cast("string")
    return log.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.when(st.rlike("^5"), 1).otherwise(0)).cast("long").alias("errors_5xx"),
        F.sum(F.when(st.rlike("^[45]"), 1).otherwise(0)).cast("long").alias("errors_4xx_5xx"),
    ).withColumn("error_pct", td("errors_5xx", "requests") * 100)


# ---------------------------------------------------------------- J3 / J4 latest state
def gauges(log: DataFrame, keys=("endpoint", "portfolio_id"), value: str = "duration") -> DataFrame:
    """Last value per label set (event time, then event id)."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    return log.groupBy(*keys).agg(F.max_by(F.col(value), order).alias("last_value"),
                                  F.max("ts").alias("last_ts"))


def model_health(log: DataFrame, key: str = "endpoint") -> DataFrame:
    """Latest state per model: healthy when its newest event succeeded."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    g = log.groupBy(key).agg(F.max_by(F.col("status"), order).alias("last_status"),
                             F.max("ts").alias("last_ts"))
    return g.withColumn("state", F.when(F.col("last_status") < 500, "healthy")
                        .otherwise("unhealthy")) \
        .withColumn("health", F.when(F.col("last_status") < 500, 1.0).otherwise(0.0))


def health_states(log: DataFrame, key: str = "model", stale_seconds: int = 3600, window_seconds: int = 3600,
                  degraded_share: float = 0.1) -> DataFrame:
    """J4 with all four states, as of the log's newest event: unknown when a model
    was silent for longer than ``stale_seconds``, unhealthy when its newest event
    failed, degraded when at least ``degraded_share`` of its events in the last
    ``window_seconds`` did, else healthy."""
    now = F.unix_timestamp(F.lit(log.agg(F.max("ts")).first()[0]))
    order = F.struct(F.col("ts"), F.col("event_id"))
    age = now - F.unix_timestamp("ts")
    recent = age < window_seconds
    g = log.groupBy(key).agg(
        F.max_by("status", order).alias("last_status"), F.max("ts").alias("last_ts"),
        F.count_if(recent).alias("recent"), F.count_if(recent & (F.col("status") >= 500)).alias("recent_errors"))
    share = td("recent_errors", "recent")
    state = (F.when(now - F.unix_timestamp("last_ts") > stale_seconds, "unknown")
             .when(F.col("last_status") >= 500, "unhealthy")
             .when(share >= degraded_share, "degraded").otherwise("healthy"))
    return g.select(key, "last_status", "last_ts", "recent", "recent_errors", state.alias("state"))


def down_alerts(log: DataFrame, spark, key: str = "endpoint", max_gap_seconds: int = 60, rules=UP_RULES,
                value: str | None = None) -> DataFrame:
    """J9 on J10: every rule on every silence of a target; it fires once the
    silence outlasts the rule's time."""
    table = spark.createDataFrame(list(rules), "alert string, for_seconds long, severity string")
    s = up_down(log, key, max_gap_seconds, value).withColumn("_k", F.lit(1))
    j = s.join(table.withColumn("_k", F.lit(1)), "_k")  # a fixed handful of rules
    return j.select("alert", key, F.col("down_from").alias("since"), F.col("down_until").alias("until"), "severity",
                    F.col("gap_seconds").alias("held_seconds"),
                    F.when(F.col("gap_seconds") >= F.col("for_seconds"), "firing").otherwise("pending").alias("state"))


# ---------------------------------------------------------------- J8 / J11
def confidence_gauge(log: DataFrame, key: str = "model", value: str = "confidence", bands=CONFIDENCE_BANDS) -> DataFrame:
    """Mean confidence per model with its band, red below the lowest."""
    g = log.groupBy(key).agg(F.avg(value).alias("avg_confidence"))
    band = F.lit("red")
    for low, name in sorted(bands):
        band = F.when(F.col("avg_confidence") >= low, name).otherwise(band)
    return g.withColumn("band", band)


def average_gauge(log: DataFrame, key: str = "endpoint", value: str = "duration",
                  warn: float = 0.1, crit: float = 0.5) -> DataFrame:
    """Mean with dashboard bands (fixed values: 0.1 s yellow, 0.5 s red)."""
    g = log.groupBy(key).agg(F.avg(value).alias("avg_value"))
    return g.withColumn("band", F.when(F.col("avg_value") >= crit, "red")
                        .when(F.col("avg_value") >= warn, "yellow").otherwise("green"))


def metrics_summary(log: DataFrame) -> DataFrame:
    """One row — totals, average duration, observed span in seconds."""
    return log.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.sum(F.when(F.col("status") >= 500, 1).otherwise(0)).cast("long").alias("total_errors"),
        F.avg("duration").alias("avg_duration"),
        F.countDistinct("endpoint").alias("n_endpoints"),
        F.countDistinct("portfolio_id").alias("n_portfolios"),
        (F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))).alias("uptime_seconds"))


# ---------------------------------------------------------------- J9 / J10
def evaluate_alerts(samples: DataFrame, rules: DataFrame, labels=("endpoint",),
                    step_seconds: int = 60) -> DataFrame:
    """Samples (ts, metric, labels…, value) × rules → one row per breach
    island (consecutive evaluations ``step_seconds`` apart) with its held
    duration and state: ``firing`` when held ≥ the rule's ``for``."""
    j = samples.join(rules, "metric")
    v, t = F.col("value"), F.col("threshold")
    breach = (F.when(F.col("op") == ">", v > t).when(F.col("op") == "<", v < t)
              .when(F.col("op") == ">=", v >= t).when(F.col("op") == "<=", v <= t)
              .otherwise(v == t))
    b = j.filter(breach)
    key = ["alert", *labels]
    w = Window.partitionBy(*key).orderBy("ts")
    secs = F.unix_timestamp("ts")
    gap = F.when(F.lag(secs).over(w).isNull() | ((secs - F.lag(secs).over(w)) > step_seconds), 1) \
        .otherwise(0)
    b = b.withColumn("_new", gap).withColumn("island", F.sum("_new").over(w.rowsBetween(UNB, 0)))
    g = b.groupBy(*key, "island").agg(
        F.min("ts").alias("since"), F.max("ts").alias("until"),
        F.count(F.lit(1)).alias("evaluations"), F.when(F.first("op").isin("<", "<="), F.min("value")).otherwise(F.max("value")).alias("peak_value"),
        F.first("for_seconds").alias("for_seconds"), F.first("severity").alias("severity"))
    held = F.unix_timestamp("until") - F.unix_timestamp("since")
    return g.select(*key, "since", "until", "evaluations", "peak_value", "severity",
                    held.alias("held_seconds"),
                    F.when(held >= F.col("for_seconds"), "firing").otherwise("pending").alias("state"))


def api_alerts(log: DataFrame, spark) -> DataFrame:
    """J9 on request-log samples: error rate and p95 latency per endpoint on
    5-minute windows evaluated every minute."""
    r = sliding_rates(log)
    samples = r.select(F.col("window_end").alias("ts"), "endpoint",
                       F.explode(F.array(
                           F.struct(F.lit("error_rate").alias("metric"), F.col("error_rate").alias("value")),
                           F.struct(F.lit("p95_latency").alias("metric"), F.col("p95_latency").alias("value")),
                       )).alias("_s")).select("ts", "endpoint", "_s.metric", "_s.value")
    return evaluate_alerts(samples, rules_frame(spark, API_RULES))


def _long_samples(wide: DataFrame, keys, metrics) -> DataFrame:
    """One row per (keys, metric) from one column per metric; NULLs are no samples."""
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    long = wide.select(*keys, F.explode(F.array(*entries)).alias("_s")).select(*keys, "_s.metric", "_s.value")
    return long.filter(F.col("value").isNotNull())


SYSTEM_METRICS = ("model_health", "p95_prediction_latency", "median_confidence", "memory_gb",
                  "failed_run_ratio", "transaction_cost_increase_1h", "rebalances_per_hour")


def system_samples(log: DataFrame, label: str = "model") -> DataFrame:
    """J9 samples ``(ts, label, metric, value)`` per minute with events: newest
    health and memory, p95 prediction latency over 10 minutes, median confidence
    and failed share over 30 minutes, costs and rebalancings over an hour.

    ``log`` has ``ts, event_id, status, duration, confidence, memory_gb, cost,
    rebalanced`` and the label; its newest event per minute decides gauges."""
    newest = F.struct("ts", "event_id")
    g = log.groupBy(F.window("ts", "1 minute").alias("_m"), label).agg(
        *_requests(), *bucket_counts(F.col("duration"), PREDICTION_LATENCY_BUCKETS, "lat_"),
        *bucket_counts(F.col("confidence"), CONFIDENCE_BUCKETS, "conf_"),
        F.sum("cost").alias("cost"), F.sum("rebalanced").alias("rebalanced"),
        F.max_by("status", newest).alias("status"), F.max_by("memory_gb", newest).alias("memory_gb"))
    per = g.withColumn("_s", F.unix_timestamp("_m.end"))

    def over(names, seconds):
        return [F.sum(c).over(_trailing([label], seconds)).alias(c) for c in names]

    lat = [c for c in per.columns if c.startswith("lat_")]
    conf = [c for c in per.columns if c.startswith("conf_")]
    t = per.select(F.col("_m.end").alias("ts"), label, "status", "memory_gb", *over(lat, 600),
                   *over([*conf, "requests", "errors"], 1800), *over(["cost", "rebalanced"], 3600))
    wide = t.select(
        "ts", label, "memory_gb", F.when(F.col("status") < 500, 1.0).otherwise(0.0).alias("model_health"),
        quantile_from_buckets(0.95, PREDICTION_LATENCY_BUCKETS, "lat_").alias("p95_prediction_latency"),
        quantile_from_buckets(0.5, CONFIDENCE_BUCKETS, "conf_").alias("median_confidence"),
        td("errors", "requests").alias("failed_run_ratio"),
        F.col("cost").alias("transaction_cost_increase_1h"), F.col("rebalanced").alias("rebalances_per_hour"))
    return _long_samples(wide, ["ts", label], SYSTEM_METRICS)


def system_alerts(log: DataFrame, spark, label: str = "model") -> DataFrame:
    """The model, system, run and business rules on ``system_samples``."""
    return evaluate_alerts(system_samples(log, label), rules_frame(spark, PORTFOLIO_RULES), (label,))


def portfolio_gauges(values: DataFrame, initial: float = 10000.0, periods: int = 252) -> DataFrame:
    """Per (portfolio, step) of a back-test the gauges in percent: return,
    total return, volatility (annualised, of all returns so far), worst drawdown
    so far, and the Sharpe ratio (NULL while the volatility is zero)."""
    w = Window.partitionBy("portfolio_id").orderBy("step").rowsBetween(UNB, 0)
    sd = F.stddev_pop("ret").over(w) * periods ** 0.5
    return values.select(
        "portfolio_id", "step", "value", (F.col("ret") * 100).alias("return_percentage"),
        ((F.col("value") / initial - 1) * 100).alias("total_return_percentage"),
        (sd * 100).alias("volatility_percentage"),
        (F.max("drawdown").over(w) * 100).alias("max_drawdown_percentage"),
        F.when(sd > 1e-8, F.avg("ret").over(w) * periods / sd).alias("sharpe_ratio"))


PORTFOLIO_METRICS = ("max_drawdown_percentage", "volatility_percentage", "sharpe_ratio")


def portfolio_alerts(gauges_: DataFrame, calendar: DataFrame, spark, step_seconds: int) -> DataFrame:
    """The portfolio rules on back-test gauges; ``calendar`` gives every
    step its ``date``, ``step_seconds`` the spacing of the periods."""
    dated = gauges_.join(calendar, "step").withColumn("ts", F.col("date").cast("timestamp_ntz"))
    samples = _long_samples(dated, ["ts", "portfolio_id"], PORTFOLIO_METRICS)
    return evaluate_alerts(samples, rules_frame(spark, PORTFOLIO_RULES), ("portfolio_id",), step_seconds)


def up_down(log: DataFrame, key: str = "endpoint", max_gap_seconds: int = 120, value: str | None = None) -> DataFrame:
    """Silences — consecutive events of a target further apart than
    ``max_gap_seconds`` (target considered down in between).  Two events of one
    bucket of that many seconds are never further apart, so first and last event
    per bucket tell all silences; the log is only aggregated, map-side first.
    Events without a time take no part, nor, with ``value``, samples of zero
    (``up == 0``)."""
    if value is not None:
        log = log.filter(F.col(value) != 0)
    seconds = F.unix_timestamp("ts")
    buckets = log.filter(F.col("ts").isNotNull()).groupBy(
        key, F.floor(seconds / max_gap_seconds).alias("_b")).agg(
        F.min("ts").alias("_first"), F.max("ts").alias("down_from"))
    df = buckets.withColumn("down_until", F.lead("_first").over(Window.partitionBy(key).orderBy("_b")))
    gap = F.unix_timestamp("down_until") - F.unix_timestamp("down_from")
    return df.filter(gap > max_gap_seconds).select(key, "down_from", "down_until", gap.alias("gap_seconds"))
