"""Registered queries over alert states, silences, health and labelled counters."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickloom.operators import monitoring as J
from tickloom.session import scratch_path
from tickloom.sources import adapters as AD
from tickloom.sources.tables import table
from tickloom.streaming import alerts as S
from tickloom.streaming import ticks as K


def q_system_counters(spark, sf_dir):
    return J.system_counters(AD.system_log(spark, sf_dir))


def q_health_states(spark, sf_dir):
    """J4 of every account; most were silent for the last hour."""
    log = AD.api_log(spark, sf_dir).withColumnRenamed("portfolio_id", "model")
    return J.health_states(log, stale_seconds=6 * 3600, window_seconds=5 * 86400)


def q_confidence_gauge(spark, sf_dir):
    return J.confidence_gauge(AD.system_log(spark, sf_dir))


def q_down_alerts(spark, sf_dir):
    """J10 rules per account; an event of value below one is a sample of zero."""
    log = AD.api_log(spark, sf_dir).withColumn("up", F.floor(F.least("value", F.lit(1.0))))
    return J.down_alerts(log, spark, "portfolio_id", 86400, value="up")


def _replayed(spark, sf_dir):
    ev = K.read_ticks_stream(spark, f"{sf_dir.rstrip('/')}/events.parque[t]", "parquet", table(spark, sf_dir, "events").schema)
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(spark, name, stream):
    base = scratch_path(spark, f"{name}/{uuid.uuid4().hex}")
    S.drain_states(stream, base + "/out", base + "/checkpoint")
    out = spark.read.schema(stream.schema).parquet(base + "/out")
    return out.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
                        for f in out.schema.fields])


def q_stream_up_down(spark, sf_dir):
    """J10 on the replayed events: the silences that ended."""
    events = _replayed(spark, sf_dir).withColumnRenamed("event_type", "endpoint")
    s = _drained(spark, "stream_up_down", S.silences(events, max_gap_seconds=3600, delay="0 seconds"))
    return s.filter("state = 'up'").select(F.col("target").alias("endpoint"), "down_from", "down_until", "gap_seconds")


def q_stream_alert_states(spark, sf_dir):
    """K7 on the replayed events: a value of 40 or more is a breach; ten minutes of
    breaches fire, half an hour without one resolves."""
    samples = _replayed(spark, sf_dir).select("ts", F.lit("HighValue").alias("alert"), F.col("event_type").alias("endpoint"),
                                             (F.col("value") >= 40).alias("breached"))
    return _drained(spark, "stream_alert_states", S.alert_states(samples, {"HighValue": 600}, 1800, "0 seconds"))


RAW = {
    "system_counters": q_system_counters,
    "health_states": q_health_states,
    "confidence_gauge": q_confidence_gauge,
    "down_alerts": q_down_alerts,
    "stream_up_down": q_stream_up_down,
    "stream_alert_states": q_stream_alert_states,
}
