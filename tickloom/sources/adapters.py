"""Adapters from the provided tables to the library's canonical schemas.

Every adapter is a projection (plus, for the brand series, one join and one
grouping) so the work grows with the input tables.

* ``ticks``      lineitem  -> ticker = supplier, one tick per line item
* ``tick_stream``events    -> ticker = event type, price = value, volume = props.k
* ``api_log``    events    -> request log
* ``registry``   orders    -> model registry rows
* ``training_log`` events  -> per-user training trace
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.core import td
from tickloom.sources.tables import table


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ticks(ticker, ts, date, price, volume, seq)``.

    ``seq`` = (orderkey, linenumber, partkey) is unique inside a
    (ticker, ts) group and breaks ties between ticks with equal timestamps.
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.col("l_shipdate").alias("ts"),
        F.to_date("l_shipdate").alias("date"),
        td("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("volume"),
        F.struct(F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"),
                 F.col("l_partkey").alias("k3")).alias("seq"),
    )


def tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events seen as ticks: ticker = event_type, price = value, volume = props.k."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("ticker"),
        F.col("ts"),
        F.to_date("ts").alias("date"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.struct(F.col("event_id").alias("k1")).alias("seq"),
    )


def api_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: endpoint, status (500 for error events), duration seconds, portfolio."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts",
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        (F.col("value") / 100.0).alias("duration"),
        F.col("user_id").cast("string").alias("portfolio_id"),
        F.col("value"),
    )


def system_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request log seen as predictions of three models: confidence falls
    with the event's value, memory grows with it, purchases are rebalancings
    and cost their value."""
    log = api_log(spark, sf_dir)
    bought = F.col("endpoint") == "purchase"
    return log.select(
        "event_id", "ts", F.concat(F.lit("m"), (F.col("event_id") % 3).cast("string")).alias("model"),
        "status", "duration", (F.lit(100.0) / (F.lit(100.0) + F.col("value"))).alias("confidence"),
        (F.col("value") / 100.0).alias("memory_gb"), F.when(bought, F.col("value")).otherwise(0.0).alias("cost"),
        F.when(bought, 1).otherwise(0).alias("rebalanced"), F.col("endpoint").alias("prediction_type"), "portfolio_id",
        F.when(F.col("value") >= 50, "threshold").otherwise("schedule").alias("trigger"))


# Order status letter -> registry stage.
STAGE_OF_STATUS = {"F": "Production", "O": "Staging", "P": "None"}


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model registry rows: model = order priority, version = order key."""
    o = table(spark, sf_dir, "orders")
    stage = F.coalesce(*[F.when(F.col("o_orderstatus") == k, F.lit(v))
                         for k, v in STAGE_OF_STATUS.items()], F.lit("None"))
    return o.select(
        F.col("o_orderpriority").alias("model"),
        F.col("o_orderkey").alias("version"),
        stage.alias("stage"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit("registry")).otherwise(F.lit("local")).alias("source"),
        F.col("o_orderdate").alias("loaded_at"),
        F.col("o_totalprice").alias("metric"),
        F.col("o_custkey").alias("run_owner"),
    )


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One training trace per user: step = event order, reward = value."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("ts"),
        F.col("event_id"),
        F.col("value").alias("reward"),
        F.col("event_type"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
