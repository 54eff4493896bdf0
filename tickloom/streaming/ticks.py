"""K1–K7 — the tick stream with Structured Streaming.

Unlike polling batches that aggregate each batch on its own (one hour split
across two batches gives two bars), bars here are windowed aggregates with a
watermark: state merges an hour across micro-batches and late rows older than
the watermark are dropped.  Progress (offsets + state) lives in the
checkpoint location, so a restarted query resumes exactly once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sources.commits import CommitLog

# Topic names of the message bus.
TOPICS = ("real_time_stock_data", "stock_tickers", "model_evaluation_metrics",
          "stock_data_metadata", "processed_data_metadata")

TICK_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("event_time", T.StringType()),
])

TICKER_LIST_SCHEMA = T.StructType([
    T.StructField("tickers", T.ArrayType(T.StringType())),
    T.StructField("timestamp", T.StringType()),
    T.StructField("source", T.StringType()),
])


# ---------------------------------------------------------------- K1 sources
def read_ticks_stream(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                      schema: T.StructType | str | None = None, max_files_per_trigger: int | None = None,
                      kafka_servers: str | None = None, topics=TOPICS[:1],
                      glob: str | None = None) -> DataFrame:
    """A streaming source: Kafka (``startingOffsets=earliest``) when servers
    are given, else a file or a directory of files.  Unbounded by default: a
    backfill reads all files in one micro-batch, so the watermark of an early file
    cannot make a later file's rows late.  ``max_files_per_trigger`` is for
    files that arrive in event-time order."""
    if kafka_servers:
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", kafka_servers)
                .option("subscribe", ",".join(topics))
                .option("startingOffsets", "earliest").load()
                .select(F.col("key").cast("string").alias("key"),
                        F.col("value").cast("string").alias("value"), "topic", "timestamp"))
    r = spark.readStream.format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


# ---------------------------------------------------------------- K2 parse
def parse_enrich(raw: DataFrame, value: str = "value", topic: str | None = "topic",
                 schema: T.StructType = TICK_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """JSON → typed tick rows plus ``processed_time`` and ``source_topic``;
    returns (parsed, malformed) — unparseable messages go to the second frame
    instead of being logged and lost."""
    parsed = raw.select("*", F.from_json(F.col(value), schema).alias("_m"))
    ok = parsed.filter(F.col("_m").isNotNull() & F.col("_m.ticker").isNotNull())
    bad = parsed.filter(F.col("_m").isNull() | F.col("_m.ticker").isNull()).drop("_m")
    src = F.col(topic) if topic and topic in raw.columns else F.lit(None).cast("string")
    good = ok.select("_m.*", F.current_timestamp().alias("processed_time"),
                     src.alias("source_topic"))
    good = good.withColumn("ts", F.to_timestamp("timestamp"))
    return good, bad


def explode_ticker_list(raw: DataFrame, value: str = "value") -> DataFrame:
    """Ticker-list messages ``{tickers: [...], timestamp, source}`` → one row per ticker."""
    m = F.from_json(F.col(value), TICKER_LIST_SCHEMA).alias("_m")
    return raw.select(m).select(F.explode("_m.tickers").alias("ticker"), "_m.timestamp", "_m.source")


def to_messages(df: DataFrame, key: str = "ticker") -> DataFrame:
    """A10: rows → (key, value) with the row as JSON, ISO timestamps."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd'T'HH:mm:ss").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*cols)).alias("value"))


# ---------------------------------------------------------------- K4 bars
def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ)."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def bars_stream(ticks: DataFrame, width: str = "1 hour", delay: str = "10 minutes",
                price: str = "price", volume: str = "volume") -> DataFrame:
    """E1 on a stream: tumbling event-time windows per ticker, watermarked;
    append mode emits a bar once the watermark passes its window end."""
    p = F.col(price)
    order = F.when(p.isNotNull(), F.struct(F.col("ts"), F.col("seq")))
    g = ticks.withWatermark("ts", delay).groupBy("ticker", F.window("ts", width).alias("w")).agg(
        F.min_by(p, order).alias("open"), F.max(p).alias("high"), F.min(p).alias("low"),
        F.max_by(p, order).alias("close"), F.sum(F.col(volume)).alias("volume"),
        F.count(F.lit(1)).alias("n_ticks"))
    start = F.col("w.start")
    return g.select("ticker", F.to_date(start).alias("date"), F.hour(start).cast("long").alias("hour"),
                    "open", "high", "low", "close", "volume", "n_ticks")


def metrics_stream(log: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """K6: J5 request / error rates on 5-minute windows sliding by 1 minute."""
    g = log.withWatermark("ts", delay).groupBy(
        F.window("ts", "5 minutes", "1 minute").alias("w"), "endpoint").agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.when(F.col("status") >= 500, 1).otherwise(0)).cast("long").alias("errors"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "endpoint", "requests", "errors", (F.col("requests") / 300).alias("request_rate"),
                    (F.col("errors") / 300).alias("error_rate"))


# ---------------------------------------------------------------- K7 alerts with state
ALERT_OUT = ("alert string, endpoint string, since timestamp, fired_at timestamp, "
             "held_seconds long")
ALERT_STATE = "since long, last long, fired boolean"


def alert_state_fn(for_seconds: dict, step_seconds: int = 60) -> Callable:
    """Per (alert, endpoint): extend the current breach island, open a new
    one after a gap, emit one row when the island has held for ``for``."""

    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        alert, endpoint = key
        since, last, fired = state.get if state.exists else (None, None, False)
        rows = []
        # A key's rows may come in several frames, which are not in time order.
        seconds = [pd.to_datetime(pdf["ts"]).astype("datetime64[s]").astype("int64").unique() for pdf in pdfs]
        for t in sorted({int(t) for part in seconds for t in part}):
            if last is None or t - last > step_seconds:
                since, fired = t, False
            last = max(last or t, t)
            if not fired and last - since >= for_seconds[alert]:
                fired = True
                rows.append((alert, endpoint, pd.Timestamp(since, unit="s"),
                             pd.Timestamp(last, unit="s"), last - since))
        state.update((since, last, fired))
        yield pd.DataFrame(rows, columns=["alert", "endpoint", "since", "fired_at", "held_seconds"])

    return fn


def alerts_stream(breaches: DataFrame, rules=None, delay: str = "10 minutes") -> DataFrame:
    """K7: ``breaches(ts, alert, endpoint)`` → firing events that persist
    across micro-batches (state per rule and label set)."""
    from tickloom.operators.monitoring import API_RULES, PORTFOLIO_RULES
    rules = rules or API_RULES + PORTFOLIO_RULES
    fors = {r[0]: r[4] for r in rules}
    return breaches.withWatermark("ts", delay).groupBy("alert", "endpoint").applyInPandasWithState(
        alert_state_fn(fors), ALERT_OUT, ALERT_STATE, "append", "NoTimeout")


# ---------------------------------------------------------------- K3 / K5 sinks
def drain(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
          output_mode: str = "append", foreach_batch: Callable | None = None,
          query_name: str | None = None):
    """Run a stream to completion over what is available now
    (``availableNow``), commit through the checkpoint, and write each
    micro-batch (or hand it to ``foreach_batch`` — the per-message callback
    surface, run on the cluster, not a driver thread)."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).option("path", sink_path).start()
    q.awaitTermination()
    return q


def drain_latest(stream: DataFrame, keys, path: str, checkpoint: str) -> DataFrame:
    """Drain a windowed aggregate in update mode and return the newest state of
    every key, also of windows that the watermark has not closed.  Each
    micro-batch overwrites its own folder, so one that is run again leaves no
    second copy."""
    drain(stream, path, checkpoint, output_mode="update", foreach_batch=lambda batch, epoch: batch.write.mode(
        "overwrite").parquet(f"{path.rstrip('/')}/batch_epoch={epoch}"))
    values = [c for c in stream.columns if c not in keys]
    newest = stream.sparkSession.read.parquet(path).groupBy(*keys).agg(
        F.max_by(F.struct(*values), "batch_epoch").alias("_v"))
    return newest.select(*keys, "_v.*")


def write_batch(batch: DataFrame, epoch_id: int, path: str, prefix: str = "batch") -> None:
    """One micro-batch under ``path/prefix_epoch=…``, exactly once.  A retried
    epoch overwrites its own folder, and its commit is published last; an epoch
    that is committed already is left alone.  Empty batches write no data."""
    log = CommitLog(batch.sparkSession, f"{path.rstrip('/')}/_commits")
    if log.has(epoch_id):
        return
    folder = f"{prefix}_epoch={epoch_id}"
    empty = batch.isEmpty()
    if not empty:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{folder}")
    log.publish(epoch_id, {"epoch": epoch_id, "folder": None if empty else folder, "schema": batch.schema.json()})


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of committed epochs only; a folder whose epoch was never committed
    is not seen.  A sink without commits raises."""
    log = CommitLog(spark, f"{path.rstrip('/')}/_commits")
    commits = [log.read(n) for n in log.numbers()]
    if not commits:
        raise FileNotFoundError(f"{path} has no committed epoch")
    schema = T.StructType.fromJson(json.loads(commits[-1]["schema"]))
    folders = [f"{path.rstrip('/')}/{c['folder']}" for c in commits if c["folder"]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
