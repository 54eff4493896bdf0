"""K7, J10 — alert states and silences on a stream, with event-time timers.

Both processors keep a key's samples of the time the watermark has not passed, and
decide when it passes them, in time order.  What they say therefore does not depend
on how the samples were cut into micro-batches or in which order they came; a
sample later than the watermark is dropped.  State goes away with the last timer of
a key: an alert that was resolved leaves nothing behind, a target leaves the time
it was seen last.

Samples are reduced before they are kept (alerts: one per second; silences: first and
last per bucket of the allowed gap), so a key's state is bounded by the watermark's
delay, not by its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ALERT_STATES = ("alert string, endpoint string, state string, at timestamp, since timestamp, held_seconds long")
SILENCES = "target string, state string, down_from timestamp, down_until timestamp, gap_seconds long"


@contextmanager
def timer_state(spark: SparkSession):
    """Queries started inside keep their state where timers are possible."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _micros(column: pd.Series) -> pd.Series:
    return pd.to_datetime(column).astype("datetime64[us]").astype("int64")


def _stamp(micros: int) -> pd.Timestamp:
    return pd.Timestamp(micros, unit="us")


class AlertStates(StatefulProcessor):
    """pending at the first breach of an island, firing once it has held for the
    rule's time, resolved by a sample that is no breach or by none at all for
    longer than ``step_seconds``."""

    def __init__(self, for_seconds: dict, step_seconds: int):
        self.for_seconds, self.step = for_seconds, step_seconds

    def init(self, handle) -> None:
        self.handle = handle
        self.samples = handle.getListState("samples", "t long, breached boolean")
        self.island = handle.getValueState("island", "since long, last long, fired boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        passed = timerValues.getCurrentWatermarkInMs()
        new: dict[int, bool] = {}
        for pdf in rows:
            seconds = _micros(pdf["ts"]) // 1_000_000
            for t, breached in zip(seconds.tolist(), pdf["breached"].tolist()):
                if t * 1000 > passed:
                    new[t] = new.get(t, False) or bool(breached)  # of one second a breach counts
        if new:
            self.samples.appendList(sorted(new.items()))
            self.handle.registerTimer(min(new) * 1000 - 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        now = timerValues.getCurrentWatermarkInMs()
        alert, endpoint = key
        since, last, fired = self.island.get() if self.island.exists() else (None, None, False)
        held: dict[int, bool] = {}
        for t, breached in (self.samples.get() if self.samples.exists() else []):
            held[t] = held.get(t, False) or breached
        out = []

        def say(state, at):
            out.append((alert, endpoint, state, _stamp(at * 1_000_000), _stamp(since * 1_000_000), at - since))

        for t in sorted(t for t in held if t * 1000 <= now):
            breached = held.pop(t)
            if since is not None and t - last > self.step:
                say("resolved", last + self.step)
                since = None
            if breached:
                if since is None:
                    since, fired = t, False
                    say("pending", t)
                last = t
                if not fired and last - since >= self.for_seconds[alert]:
                    fired = True
                    say("firing", t)
            elif since is not None:
                say("resolved", t)
                since = None
        if since is not None and now > (last + self.step) * 1000:
            say("resolved", last + self.step)
            since = None
        if held:
            self.samples.put(sorted(held.items()))
            self.handle.registerTimer(min(held) * 1000 - 1)
        else:
            self.samples.clear()
        if since is None:
            self.island.clear()
        else:
            self.island.update((since, last, fired))
            self.handle.registerTimer((last + self.step) * 1000)
        return iter([pd.DataFrame(out, columns=["alert", "endpoint", "state", "at", "since", "held_seconds"])] if out else [])

    def close(self) -> None:
        pass


class Silences(StatefulProcessor):
    """down once a target was not seen for longer than ``max_gap`` seconds, up with
    its next sign of life."""

    def __init__(self, max_gap: int):
        self.max_gap = max_gap

    def init(self, handle) -> None:
        self.handle = handle
        self.buckets = handle.getListState("buckets", "b long, first long, last long")
        self.seen = handle.getValueState("seen", "last long, down boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        passed = timerValues.getCurrentWatermarkInMs()
        new: dict[int, tuple[int, int]] = {}
        for pdf in rows:
            t = _micros(pdf["ts"])
            t = t[t // 1000 > passed]
            for b, low, high in t.groupby(t // (self.max_gap * 1_000_000)).agg(["min", "max"]).itertuples():
                had = new.get(b, (low, high))
                new[b] = (min(low, had[0]), max(high, had[1]))
        if new:
            self.buckets.appendList([(b, low, high) for b, (low, high) in sorted(new.items())])
            self.handle.registerTimer(min(low for low, _ in new.values()) // 1000 - 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        now = timerValues.getCurrentWatermarkInMs()
        seen, down = self.seen.get() if self.seen.exists() else (None, False)
        held: dict[int, tuple[int, int]] = {}
        for b, low, high in (self.buckets.get() if self.buckets.exists() else []):
            had = held.get(b, (low, high))
            held[b] = (min(low, had[0]), max(high, had[1]))
        out = []

        def silent(until):  # seconds since the target was seen
            return until // 1_000_000 - seen // 1_000_000

        for first, b in sorted((low, b) for b, (low, _) in held.items() if low // 1000 <= now):
            if seen is not None and silent(first) > self.max_gap:
                if not down:
                    out.append((key[0], "down", _stamp(seen), None, None))
                out.append((key[0], "up", _stamp(seen), _stamp(first), silent(first)))
            last = held.pop(b)[1]
            seen, down = (last if seen is None else max(seen, last)), False
        if not down and seen is not None and silent(now * 1000) > self.max_gap:
            down = True
            out.append((key[0], "down", _stamp(seen), None, None))
        if held:
            self.buckets.put([(b, low, high) for b, (low, high) in sorted(held.items())])
            self.handle.registerTimer(min(low for low, _ in held.values()) // 1000 - 1)
        else:
            self.buckets.clear()
        if seen is not None:
            self.seen.update((seen, down))
            if not down:
                self.handle.registerTimer((seen // 1_000_000 + self.max_gap + 1) * 1000)
        frame = pd.DataFrame(out, columns=["target", "state", "down_from", "down_until", "gap_seconds"])
        return iter([frame.astype({"gap_seconds": "Int64", "down_until": "datetime64[us]"})] if out else [])

    def close(self) -> None:
        pass


def alert_states(samples: DataFrame, for_seconds: dict, step_seconds: int = 60, delay: str = "10 minutes") -> DataFrame:
    """K7: ``samples(ts, alert, endpoint, breached)`` → every change of state, with
    the time it holds from, the island's start and how long it has held."""
    return samples.select("ts", "alert", "endpoint", "breached").withWatermark("ts", delay).groupBy(
        "alert", "endpoint").transformWithStateInPandas(
            AlertStates(for_seconds, step_seconds), ALERT_STATES, "Append", "EventTime")


def silences(events: DataFrame, target: str = "endpoint", max_gap_seconds: int = 120, delay: str = "10 minutes",
             value: str | None = None) -> DataFrame:
    """Targets that go down and come up.  With ``value`` a sample of zero is no
    sign of life (``up == 0``)."""
    alive = events if value is None else events.filter(F.col(value) != 0)
    return alive.select(F.col(target).alias("target"), "ts").withWatermark("ts", delay).groupBy(
        "target").transformWithStateInPandas(Silences(max_gap_seconds), SILENCES, "Append", "EventTime")


def drain_states(stream: DataFrame, path: str, checkpoint: str, on_batch: Callable | None = None):
    """Run a stream of states over what is available now."""
    from tickloom.streaming.ticks import drain
    with timer_state(stream.sparkSession):
        return drain(stream, path, checkpoint, foreach_batch=on_batch)
