"""Alert states and silences with event-time timers, and the exactly-once sink."""

import datetime as dt

import pytest

from tickloom.operators import monitoring as J
from tickloom.streaming import alerts as S
from tickloom.streaming import ticks as K

T0 = dt.datetime(2024, 1, 1, 10)
SAMPLE = "ts timestamp, alert string, endpoint string, breached boolean"


def minute(k):
    return T0 + dt.timedelta(minutes=k)


def replay(spark, path, batches, schema):
    """A stream that reads one file a micro-batch, in the order given."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/in/b{i:02d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{path}/in")


def test_alerts_resolve_with_late_and_absent_samples(spark, tmp_path):
    def s(k, breached=True, endpoint="x"):
        return (minute(k), "R", endpoint, breached)

    batches = [[s(0), s(2), s(1)],                          # out of order
               [s(3), s(4), s(30)],                         # silence after minute 4
               [s(31, False), s(5), s(50), s(0, True, "y")],  # a calm sample; minute 5 is too late, so is y
               [s(51), s(90, False), s(91, True, "z")]]
    stream = replay(spark, str(tmp_path), batches, SAMPLE)
    out = str(tmp_path / "out")
    S.drain_states(S.alert_states(stream, {"R": 180}, 60, "0 seconds"), out, str(tmp_path / "ck"))
    got = sorted((r.endpoint, r.at, r.state, r.since, r.held_seconds) for r in spark.read.parquet(out).collect())
    want = [("x", 0, "pending", 0), ("x", 3, "firing", 0), ("x", 5, "resolved", 0), ("x", 30, "pending", 30), ("x", 31, "resolved", 30),
            ("x", 50, "pending", 50), ("x", 52, "resolved", 50), ("z", 91, "pending", 91)]
    assert got == sorted((e, minute(a), st, minute(b), (a - b) * 60) for e, a, st, b in want)


@pytest.mark.parametrize("cut", [1, 4])
def test_silences_equal_the_batch_operator(spark, tmp_path, cut):
    import random
    random.seed(5)
    t, rows = 0.0, []
    for i in range(160):
        t += random.choice([5, 20, 61, 119, 121, 400, 3000])
        rows.append((T0 + dt.timedelta(seconds=t), "hot" if i % 3 else f"t{i % 2}", random.choice([0.0, 1.0, 2.0])))
    schema = "ts timestamp, endpoint string, v double"
    stream = replay(spark, str(tmp_path), [rows[i * 160 // cut: (i + 1) * 160 // cut] for i in range(cut)], schema)
    out = str(tmp_path / "out")
    S.drain_states(S.silences(stream, max_gap_seconds=120, delay="0 seconds", value="v"), out, str(tmp_path / "ck"))
    got = spark.read.parquet(out)
    up = {(r.target, r.down_from, r.down_until, r.gap_seconds) for r in got.filter("state = 'up'").collect()}
    want = {tuple(r) for r in J.up_down(spark.createDataFrame(rows, schema), "endpoint", 120, "v").collect()}
    assert up == want and want
    down = {(r.target, r.down_from) for r in got.filter("state = 'down'").collect()}
    assert {(k, a) for k, a, _, _ in want} <= down  # every silence was told, at the latest when it ended


def test_a_replayed_epoch_is_written_once(spark, tmp_path):
    path = str(tmp_path / "sink")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    with pytest.raises(FileNotFoundError):
        K.read_committed(spark, path)
    K.write_batch(a, 0, path)
    K.write_batch(a, 0, path)  # a retry after the commit
    a.limit(1).write.parquet(f"{path}/batch_epoch=1")  # an epoch that died before its commit
    assert K.read_committed(spark, path).count() == 2
    K.write_batch(a, 1, path)  # its retry
    K.write_batch(a.limit(0), 2, path)
    assert sorted(r.i for r in K.read_committed(spark, path).collect()) == [1, 1, 2, 2]


def test_health_states(spark):
    rows = [("ok", 0, 200), ("ok", 50, 200), ("bad", 0, 200), ("bad", 59, 500), ("half", 0, 200), ("half", 30, 500), ("half", 55, 200),
            ("gone", -200, 200), ("ok", 60, 200)]
    log = spark.createDataFrame([(m, minute(k), i, st) for i, (m, k, st) in enumerate(rows)], "model string, ts timestamp, event_id int, status int")
    got = {r.model: r.state for r in J.health_states(log, stale_seconds=3600, window_seconds=3600).collect()}
    assert got == {"ok": "healthy", "bad": "unhealthy", "half": "degraded", "gone": "unknown"}


def test_ticker_lists_explode(spark):
    raw = spark.createDataFrame([('{"tickers": ["A", "B"], "timestamp": "t", "source": "s"}',), ("no json",), ('{"tickers": []}',)], "value string")
    assert [tuple(r) for r in K.explode_ticker_list(raw).orderBy("ticker").collect()] == [("A", "t", "s"), ("B", "t", "s")]


def test_confidence_bands(spark):
    log = spark.createDataFrame([("a", 0.9), ("b", 0.7), ("c", 0.2), ("d", 0.8)], "model string, confidence double")
    assert {r.model: r.band for r in J.confidence_gauge(log).collect()} == {"a": "green", "b": "yellow", "c": "red", "d": "green"}
