"""Registered queries over store, join, source, message and alert operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickloom.operators import backtest as G
from tickloom.operators import clean as C
from tickloom.operators import joins as D
from tickloom.operators import monitoring as J
from tickloom.operators import quality as Q
from tickloom.operators import scoring as I
from tickloom.operators import store as H
from tickloom.operators import training_log as L
from tickloom.plans import market as M
from tickloom.session import materialize, scratch_path
from tickloom.sources import adapters as AD
from tickloom.sources import files as A
from tickloom.sources.tables import table
from tickloom.streaming import ticks as K

WEEK = 7 * 86400


# ---------------------------------------------------------------- monitoring
def q_rate_windows(spark, sf_dir):
    return J.rate_windows(AD.api_log(spark, sf_dir))


def q_prediction_histogram(spark, sf_dir):
    return J.histogram(AD.system_log(spark, sf_dir), ("model",), "duration", J.PREDICTION_LATENCY_BUCKETS)


def q_confidence_histogram(spark, sf_dir):
    return J.histogram(AD.system_log(spark, sf_dir), ("model",), "confidence", J.CONFIDENCE_BUCKETS)


def q_system_alerts(spark, sf_dir):
    return J.system_alerts(AD.system_log(spark, sf_dir), spark)


def _gauges(spark, sf_dir):
    panel, acts, t, n = M.backtest_inputs(spark, sf_dir)
    return panel, J.portfolio_gauges(G.backtest(panel, acts, n_steps=t, n_assets=n))


def q_portfolio_gauges(spark, sf_dir):
    return _gauges(spark, sf_dir)[1]


def q_portfolio_alerts(spark, sf_dir):
    panel, gauges = _gauges(spark, sf_dir)
    return J.portfolio_alerts(gauges, panel.select("step", "date").distinct(), spark, WEEK)


# ---------------------------------------------------------------- training log, requests
def _backtest_log(spark, sf_dir):
    """A back-test as training log: one run per portfolio, steps from 1."""
    panel, acts, t, n = M.backtest_inputs(spark, sf_dir)
    bt = materialize(G.backtest(panel, acts, n_steps=t, n_assets=n), "backtest_log")
    first = G.BacktestParams().window
    return bt.select(F.col("portfolio_id").alias("run_id"), (F.col("step") - first).alias("step"), "reward", "ret",
                     "drawdown", "value")


def q_backtest_training_progress(spark, sf_dir):
    return L.training_progress(_backtest_log(spark, sf_dir), 10, 5)


def q_backtest_training_summary(spark, sf_dir):
    log = _backtest_log(spark, sf_dir)
    return L.training_summary(log, L.training_progress(log, 10, 5))


def q_trailing_failure_ratio(spark, sf_dir):
    return L.failure_ratio(AD.training_log(spark, sf_dir), slide="1 minute")


def _requests(spark, sf_dir):
    """One request per supplier: its newest weights, the last 30 closes of the
    assets it holds, its account balance and a risk tolerance from its nation."""
    bb = M.materialized_brand_bars(spark, sf_dir)
    closes = C.latest_window(M.price_panel(spark, sf_dir, bb).select("ticker", "step", "close"), n=30, order="step")
    history = closes.groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("step", "close")))["close"].alias("closes"))
    held = I.current_weights(G.normalize_weights(M.portfolio_actions(spark, sf_dir, bb))).join(history, "ticker", "left")
    held = held.groupBy("portfolio_id").agg(F.sort_array(F.collect_list(F.struct("ticker", "weight", "closes"))).alias("_h"))
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("portfolio_id"), F.col("s_acctbal").alias("portfolio_value"),
        (F.col("s_nationkey") / 20.0).alias("risk_tolerance"))
    return supplier.join(held, "portfolio_id", "left").select(
        "portfolio_id", "portfolio_value", "risk_tolerance", F.col("_h.weight").alias("weights"),
        F.array(F.col("_h.closes")).alias("market_data"))


def q_scored_requests(spark, sf_dir):
    """Requests with a negative balance, a tolerance above 1 or no
    holdings are rejected with their reason."""
    return I.score_requests(Q.validate_requests(_requests(spark, sf_dir)))


# ---------------------------------------------------------------- joins
def q_common_dates(spark, sf_dir):
    return D.common_dates(M.brand_bars(spark, sf_dir))


def q_missing_features(spark, sf_dir):
    """Customers expected to order, less those who did before 1996."""
    expected = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("feature"))
    orders = A.date_range(table(spark, sf_dir, "orders"), end="1995-12-31", col="o_orderdate")
    return D.missing_features(expected, orders.select(F.col("o_custkey").alias("feature")))


def q_runs_with_versions(spark, sf_dir):
    """Orders as runs, their line items as registered versions."""
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("status"))
    versions = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("version"), F.col("l_quantity").alias("metric"))
    return H.runs_with_versions(runs, versions)


# ---------------------------------------------------------------- sources
def q_date_range_ticks(spark, sf_dir):
    """A5: ticks of 1996, per supplier."""
    t = A.date_range(AD.ticks(spark, sf_dir), "1996-01-01", "1996-12-31")
    return t.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_ticks"), F.sum("volume").alias("volume"))


def q_lookback_ticks(spark, sf_dir):
    """A5: ticks of the two years up to 1997-06-30, per supplier."""
    t = A.lookback(AD.ticks(spark, sf_dir), "1997-06-30", 2.0)
    return t.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_ticks"), F.sum("volume").alias("volume"))


def q_merged_snapshots(spark, sf_dir):
    """A5: events as overlapping snapshots of (user, type); the newest wins."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    return A.merge_snapshots(ev, ("user_id", "event_type"), "ts")


# ---------------------------------------------------------------- store
def q_upserted_weights(spark, sf_dir):
    """H7: the exact weights of every step are stored, and arrive again cut to
    eighths, so that some no longer sum to 1 and are refused; where they do, the
    incoming snapshot of a time replaces the stored one."""
    w = G.normalize_weights(M.portfolio_actions(spark, sf_dir)).withColumnRenamed("step", "updated_at")
    w = w.select("portfolio_id", "ticker", "weight", "updated_at")
    updates = w.withColumn("weight", F.floor(F.col("weight") * 8) / 8)
    return H.upsert_portfolio_weights(w, updates)


def q_model_info(spark, sf_dir):
    i = H.model_info(AD.registry(spark, sf_dir), "1-URGENT")
    return i.select("model", "version", "stage", "source", "loaded_at", F.col("metrics")["metric"].alias("metric"),
                    F.col("params")["source"].alias("param_source"))


def q_run_report(spark, sf_dir):
    """Training totals, request averages and error share of every user."""
    log = AD.training_log(spark, sf_dir)
    training = L.training_summary(log, L.training_progress(log, 10, 5)).select("run_id", "n_steps", "best_mean_reward")
    api = AD.api_log(spark, sf_dir).withColumnRenamed("portfolio_id", "run_id")
    evaluation = J.average_gauge(api, "run_id").select("run_id", "avg_value", "band")
    gate = J.error_ratio(api, ("run_id",)).select("run_id", "errors_5xx")
    r = H.run_report(training, evaluation, gate, "run_id")
    return r.select("run_id", "n_steps", "best_mean_reward", "avg_value", "band", "errors_5xx",
                    F.get_json_object("report", "$.band").alias("report_band"),
                    F.get_json_object("report", "$.n_steps").cast("long").alias("report_steps"))


# ---------------------------------------------------------------- messages
def _messages(spark, sf_dir):
    """Events as messages; error events carry their bare properties, which are
    JSON but no tick."""
    ev = table(spark, sf_dir, "events")
    tick = ev.select("event_id", F.col("event_type").alias("ticker"), F.col("ts").alias("timestamp"),
                     F.col("value").alias("close"), "props", F.lit(K.TOPICS[0]).alias("topic"))
    body = K.to_messages(tick.drop("props", "topic")).withColumn(
        "event_id", F.get_json_object("value", "$.event_id").cast("long"))
    return body.join(tick.select("event_id", "props", "topic"), "event_id").select(
        "event_id", "key", "topic", F.when(F.col("key") == "error", F.col("props")).otherwise(F.col("value")).alias("value"))


def q_parsed_messages(spark, sf_dir):
    """A10, K2: messages back to ticks, totalled per ticker and topic."""
    good, _ = K.parse_enrich(Q.require_columns(_messages(spark, sf_dir), ["value", "topic"]))
    return good.groupBy("ticker", "source_topic").agg(
        F.count(F.lit(1)).alias("n_ticks"), F.sum("close").alias("close_sum"),
        F.min("ts").cast("timestamp_ntz").alias("first_ts"), F.max("ts").cast("timestamp_ntz").alias("last_ts"))


def q_malformed_messages(spark, sf_dir):
    """Messages that are no tick, unchanged."""
    _, bad = K.parse_enrich(_messages(spark, sf_dir))
    return bad.select("event_id", "key", "value")


def q_stream_request_rates(spark, sf_dir):
    """K6: the events replayed as a stream; requests and errors per sliding window."""
    ev = K.read_ticks_stream(spark, f"{sf_dir.rstrip('/')}/events.parque[t]", "parquet",
                             table(spark, sf_dir, "events").schema)
    log = ev.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("endpoint"),
                    F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"))
    base = scratch_path(spark, f"stream_request_rates/{uuid.uuid4().hex}")
    r = K.drain_latest(K.metrics_stream(log), ["window_start", "window_end", "endpoint"],
                       base + "/out", base + "/checkpoint")
    return r.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


RAW = {
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
