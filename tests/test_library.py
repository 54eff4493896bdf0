"""Library functions that are not registered queries: file layouts, store
helpers, quantiles, scoring helpers and the stateful alert stream."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.plans.catalog import daily_bars

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bars3(spark):
    b = daily_bars(spark, SF)
    keep = [r[0] for r in b.groupBy("ticker").count().orderBy(F.desc("count"), "ticker").limit(3).collect()]
    return b.filter(F.col("ticker").isin(keep)).select("ticker", "date", "open", "high", "low", "close",
                                                       "volume")


def _wide_csv(rows, tickers, path):
    dates = sorted({r.date for r in rows})
    by = {(r.ticker, r.date): r for r in rows}
    feats = ["Open", "High", "Low", "Close", "Volume"]
    with open(path, "w") as f:
        f.write("Price," + ",".join(ft for ft in feats for _ in tickers) + "\n")
        f.write("Ticker," + ",".join(t for _ in feats for t in tickers) + "\n")
        for d in dates:
            cells = []
            for ft in feats:
                for t in tickers:
                    r = by.get((t, d))
                    cells.append("" if r is None else repr(getattr(r, ft.lower())))
            f.write(d.isoformat() + "," + ",".join(cells) + "\n")


def test_wide_csv_round_trip(spark, bars3, tmp_path):
    from tickloom.sources import files as A
    rows = bars3.collect()
    tickers = sorted({r.ticker for r in rows})
    path = str(tmp_path / "wide.csv")
    _wide_csv(rows, tickers, path)
    df = A.read_ohlcv(spark, path)
    info = A.detect_layout(df)
    assert info["layout"] == "wide" and info["tickers"] == tickers
    long = A.to_bars(df).filter(F.col("close").isNotNull())
    got = {(r.ticker, r.date, r.close, r.volume) for r in long.collect()}
    assert got == {(r.ticker, r.date, r.close, r.volume) for r in rows}


def test_long_layout_defaults_and_absent_ticker(spark, bars3):
    from tickloom.sources import files as A
    long = bars3.select(F.col("ticker"), "date", F.col("close").alias("Close"))
    t = sorted(r[0] for r in bars3.select("ticker").distinct().collect())
    out = A.to_bars(long, tickers=t + ["ZZZ"])
    r = out.filter(F.col("ticker") == t[0]).first()
    assert r.open == r.close and r.volume == 1_000_000.0          # O/H/L <- Close, Volume default
    z = out.filter(F.col("ticker") == "ZZZ").first()
    assert (z.open, z.high, z.low, z.close, z.volume) == (100.0, 110.0, 120.0, 130.0, 1e6)


def test_normalize_tickers(spark):
    from tickloom.sources import files as A
    df = spark.createDataFrame([("AAPL",), ("msft",), (" GOOGL ",), ("  ",), (None,)], "ticker string")
    assert [r[0] for r in A.normalize_tickers(df).collect()] == ["AAPL", "MSFT", "GOOGL"]


def test_merge_snapshots_newest_wins(spark):
    from tickloom.sources import files as A
    d = dt.date(2024, 1, 2)
    df = spark.createDataFrame([("A", d, 1.0, "2024-01-03"), ("A", d, 2.0, "2024-01-05")],
                               "ticker string, date date, close double, snapshot_date string")
    assert A.merge_snapshots(df).first().close == 2.0


def test_exact_quantiles_match_numpy(spark):
    from tickloom.functions.quantiles import exact_quantiles
    rng = np.random.default_rng(7)
    vals = rng.normal(size=2001).round(3).tolist() + [5.0] * 700   # a hot value
    df = spark.createDataFrame([("x", float(v)) for v in vals], "column string, value double") \
        .repartition(7)
    got = {r.q: r.quantile for r in exact_quantiles(df, (0.1, 0.25, 0.5, 0.9)).collect()}
    for q, v in got.items():
        assert math.isclose(v, float(np.quantile(vals, q)), rel_tol=1e-12, abs_tol=1e-12)


def test_exact_quantiles_of_several_keys_with_nulls(spark):
    from tickloom.functions.quantiles import exact_quantiles
    rows = [("a", 1.0), ("a", 2.0), ("b", 7.0), ("b", None), ("none", None)]
    df = spark.createDataFrame(rows, "column string, value double").repartition(3)
    got = {(r["column"], r.q): r["quantile"] for r in exact_quantiles(df, (0.0, 0.5, 1.0)).collect()}
    assert got == {("a", 0.0): 1.0, ("a", 0.5): 1.5, ("a", 1.0): 2.0,
                   ("b", 0.0): 7.0, ("b", 0.5): 7.0, ("b", 1.0): 7.0}


def test_sequence_number(spark):
    from pyspark.sql import functions as F
    from tickloom.functions.sequence import sequence_number
    rows = [("hot", i, i * 10) for i in range(500)] + [("cold", i, i) for i in range(5)] \
        + [(None, 0, None), (None, 1, 3)]
    df = spark.createDataFrame(rows, "k string, id long, t long").repartition(5)
    s = sequence_number(df, ["k"], ["t", "id"], F.floor(F.col("t") / 70))
    assert {(r.k, r.id, r.seq) for r in s.collect()} == \
        {(k, i, i + 1) for k, i, _ in rows}


def test_up_down_equals_next_event_per_target(spark):
    from tickloom.operators.monitoring import up_down
    rng = np.random.default_rng(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(milliseconds=int(ms)), i) for k in ("a", "b")
            for i, ms in enumerate(np.cumsum(rng.choice([500, 60_000, 119_999, 120_000, 121_500, 400_000], 300)))]
    df = spark.createDataFrame(rows + [("a", None, 999)], "endpoint string, ts timestamp, event_id long").repartition(4)
    expected = {(k, a, b) for (k, a, _), (k2, b, _) in zip(rows, rows[1:])
                if k == k2 and int(b.timestamp()) - int(a.timestamp()) > 120}
    assert {(r.endpoint, r.down_from, r.down_until) for r in up_down(df).collect()} == expected and expected


def test_dense_panel_keeps_every_date_or_raises(spark):
    from tickloom.operators.clean import dense_panel
    days = [dt.date(2024, 1, d) for d in (1, 2, 5, 8)]
    bars = spark.createDataFrame([("A", d, 1.0) for d in days] + [("B", days[1], 2.0)],
                                 "ticker string, date date, close double")
    got = dense_panel(bars).collect()
    assert {(r.ticker, r.date) for r in got} == {(t, d) for t in "AB" for d in days}
    assert sum(r.close is not None for r in got) == 5
    with pytest.raises(Exception, match="lattice"):
        dense_panel(bars, step="7 days").collect()
    assert dense_panel(bars.limit(0)).count() == 0


def test_unknown_volatility_gets_nothing_and_universe_counts(spark):
    from tickloom.operators import scoring as I
    cur = spark.createDataFrame([("p", "A", 0.5), ("p", "B", 0.3), ("p", "C", 0.2)],
                                "portfolio_id string, ticker string, weight double")
    vol = spark.createDataFrame([("A", 0.1), ("B", 0.1), ("C", None)], "ticker string, vol double")
    scored = I.score_portfolios(cur, vol)
    assert {r.ticker: r.new_weight for r in scored.collect()} == {"A": 0.5, "B": 0.5, "C": 0.0}
    conf = I.rebalance_decisions(scored, universe=25).first().confidence
    assert math.isclose(conf, 1 - math.log(2) / math.log(25), abs_tol=1e-6)


@pytest.mark.parametrize("files", [1, 4, 16])
def test_stream_bars_do_not_depend_on_the_file_layout(spark, tmp_path, files):
    from tickloom.plans.catalog import QUERIES
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(files).write.parquet(
        str(tmp_path / "events.parquet"))
    batch = QUERIES["hourly_event_bars"](spark, str(tmp_path))
    stream = QUERIES["stream_hourly_bars"](spark, str(tmp_path)).select(batch.columns)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_store_helpers(spark):
    from tickloom.operators import store as H
    cat = spark.createDataFrame(
        [("1", "f", "v1", "stock", dt.datetime(2024, 1, 1)), ("2", "f", "v2", "stock", dt.datetime(2024, 2, 1)),
         ("3", "g", "v1", "model", dt.datetime(2024, 3, 1))],
        "id string, name string, version string, entity_type string, updated_at timestamp")
    latest = H.latest_versions(cat).collect()
    assert {(r.name, r.version) for r in latest} == {("f", "v2"), ("g", "v1")}
    assert [r.id for r in H.list_features(cat, entity_type="stock").collect()] == ["2", "1"]
    cur = spark.createDataFrame([("p", "A", 1.0, 1)], "portfolio_id string, ticker string, weight double, updated_at int")
    upd = spark.createDataFrame([("p", "A", 0.5, 2), ("p", "B", 0.5, 2), ("p", "A", 0.9, 3)],
                                "portfolio_id string, ticker string, weight double, updated_at int")
    kept = H.upsert_portfolio_weights(cur, upd).collect()       # version 3 sums to 0.9: rejected
    assert {(r.ticker, r.updated_at) for r in kept} == {("A", 2), ("B", 2)}
    req = spark.createDataFrame([("AAA",), ("BBB",)], "ticker string")
    have = spark.createDataFrame([("AAA",)], "ticker string")
    assert [r[0] for r in H.get_or_compute(req, have).collect()] == ["BBB"]


def test_feature_id_matches_python(spark):
    import hashlib
    import json
    from tickloom.operators import store as H
    params = {"window": 14, "alpha": "x"}
    want = hashlib.md5(f"f_v1_{json.dumps(params, sort_keys=True)}".encode()).hexdigest()
    df = spark.createDataFrame([("f", "v1")], "n string, v string").select(
        H.feature_id(F.col("n"), F.col("v"), F.create_map(F.lit("window"), F.lit("14"),
                                                          F.lit("alpha"), F.lit('"x"'))).alias("id"))
    assert df.first().id == want
    plain = spark.createDataFrame([("f", "v1")], "n string, v string").select(
        H.feature_id(F.col("n"), F.col("v")).alias("id")).first().id
    assert plain == hashlib.md5(b"f_v1").hexdigest()


def test_scoring_policies(spark):
    from tickloom.operators import quality as Q
    from tickloom.operators import scoring as I
    cur = spark.createDataFrame([("p", "A", 0.7), ("p", "B", 0.3)],
                                "portfolio_id string, ticker string, weight double")
    eq = {r.ticker: r.new_weight for r in I.score_portfolios(cur, policy="equal").collect()}
    assert eq == {"A": 0.5, "B": 0.5}
    dec = I.rebalance_decisions(I.score_portfolios(cur, policy="equal")).first()
    assert dec.rebalance_needed and abs(dec.confidence) < 1e-6

    def model(pdf):
        out = pdf[["portfolio_id", "ticker"]].copy()
        out["raw"] = [3.0, 1.0]
        return out
    m = {r.ticker: r.new_weight for r in I.apply_model(cur, model).collect()}
    assert m == {"A": 0.75, "B": 0.25}
    cube = [[[1.0, 2.0, 3.0], [1.0, 1.1, 1.0]]]
    rows = [("ok", cube, [0.5, 0.5], 100.0, 0.5), ("sum", cube, [0.6, 0.5], 100.0, 0.5),
            ("length", cube, [1.0], 100.0, 0.5), ("value", cube, [0.5, 0.5], -1.0, 0.5),
            ("risk", cube, [0.5, 0.5], 100.0, 1.5), ("empty", [], [0.5, 0.5], 100.0, 0.5),
            ("ragged", [[[1.0, 2.0], [1.0]]], [0.5, 0.5], 100.0, 0.5), ("null", None, None, None, None),
            ("flat", [[[1.0, 1.0], [2.0, 2.0]]], [0.5, 0.5], 100.0, 0.5)]
    req = spark.createDataFrame(rows, "portfolio_id string, market_data array<array<array<double>>>, "
                                      "weights array<double>, portfolio_value double, risk_tolerance double")
    checked = Q.validate_requests(req)
    assert {r.portfolio_id: r.reason for r in checked.collect()} == {
        "ok": "ok", "flat": "ok", "sum": "weights must sum to 1", "length": "weights length mismatch",
        "value": "portfolio value must be positive", "risk": "risk tolerance outside [0, 1]",
        "empty": "market data must be 3-D", "ragged": "market data must be 3-D", "null": "market data must be 3-D"}
    from tickloom.operators import scoring as I
    got = {}
    for r in I.score_requests(checked).collect():
        got.setdefault((r.portfolio_id, r.status), []).append((r.asset, r.new_weight))
    a, b = 1 / np.std([1.0, 0.5]), 1 / np.std([0.1, 1 / 1.1 - 1])
    assert [x[0] for x in got["ok", "success"]] == [0, 1]
    assert [x[1] for x in got["ok", "success"]] == pytest.approx([a / (a + b), b / (a + b)])
    assert got["flat", "error"] == [(None, None)] and got["ragged", "rejected"] == [(None, None)]
    assert len(got) == len(rows)


def test_alert_state_over_unsorted_frames():
    """K7: a key's rows may come in several frames in any order; other rules
    than the two of the request log are known."""
    import pandas as pd
    from tickloom.operators.monitoring import PORTFOLIO_RULES
    from tickloom.streaming import ticks as K

    class State:
        exists, held = False, None

        def update(self, value):
            self.held = value

    t0 = pd.Timestamp("2024-01-01 12:00")
    frames = [pd.DataFrame({"ts": [t0 + pd.Timedelta(minutes=m) for m in part]}) for part in ([3, 1], [2, 0])]
    fors = {r[0]: r[4] for r in PORTFOLIO_RULES}
    out = next(K.alert_state_fn(fors)(("CriticalMemoryUsage", "m0"), iter(frames), State()))
    assert out[["since", "fired_at", "held_seconds"]].values.tolist() == [[t0, t0 + pd.Timedelta(minutes=2), 120]]


def test_alert_stream_state(spark, tmp_path):
    """K7: an island of breaches fires once it has held for ``for``, across
    micro-batches (state), and a gap restarts the island."""
    import time
    from tickloom.streaming import ticks as K
    src = tmp_path / "in"
    src.mkdir()
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    sch = "ts timestamp, alert string, endpoint string"
    files = [[(t0 + dt.timedelta(minutes=m), "HighAPILatency", "view") for m in (0, 1)],
             [(t0 + dt.timedelta(minutes=m), "HighAPILatency", "view") for m in (2, 3)],
             [(t0 + dt.timedelta(minutes=m), "HighAPILatency", "view") for m in (10, 11)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, sch).coalesce(1).write.parquet(str(src / f"b{i}"))
        time.sleep(1.1)
    stream = spark.readStream.schema(sch).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(str(src))
    out = tmp_path / "out"
    K.drain(K.alerts_stream(stream), str(out), str(tmp_path / "ck"))
    got = [(r.since, r.fired_at, r.held_seconds) for r in spark.read.parquet(str(out)).collect()]
    assert got == [(t0, t0 + dt.timedelta(minutes=3), 180)]


def test_parse_enrich_splits_malformed(spark):
    from tickloom.streaming import ticks as K
    raw = spark.createDataFrame(
        [('{"ticker": "A", "timestamp": "2024-01-01T10:00:00", "open": 1, "high": 2, "low": 1, '
          '"close": 2, "volume": 10, "event_time": "2024-01-01T10:00:01"}', "real_time_stock_data"),
         ("not json", "real_time_stock_data")], "value string, topic string")
    good, bad = K.parse_enrich(raw)
    g = good.first()
    assert g.ticker == "A" and g.source_topic == "real_time_stock_data" and bad.count() == 1
    msgs = K.to_messages(good.select("ticker", "close"))
    assert msgs.first().key == "A" and '"close":2.0' in msgs.first().value


def test_tickers_that_are_required(spark):
    from tickloom.sources.files import normalize_tickers
    df = spark.createDataFrame([(" aa ", 1), ("", 2), (None, 3)], "ticker string, n int")
    assert [tuple(r) for r in normalize_tickers(df, required=True).collect()] == [("AA", 1)]
    bad = df.filter("n > 1")
    assert normalize_tickers(bad).count() == 0
    with pytest.raises(Exception, match="no usable ticker"):
        normalize_tickers(bad, required=True).collect()


def test_equal_weights_over_the_universe(spark):
    from tickloom.operators import scoring as I
    cur = spark.createDataFrame([("p", "A", 0.7), ("p", "B", 0.3)], "portfolio_id string, ticker string, weight double")
    every = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "ticker string")
    got = {r.ticker: (r.current_weight, r.new_weight) for r in I.score_portfolios(cur, policy="equal", universe=every).collect()}
    assert got == {"A": (0.7, 0.25), "B": (0.3, 0.25), "C": (None, 0.25), "D": (None, 0.25)}


def test_materialised_tables_are_released(spark):
    from tickloom import session
    session.release_tables(spark)
    df = session.materialize(spark.range(5), "released")
    path = df.inputFiles()[0].removeprefix("file://")
    import os
    assert df.count() == 5 and os.path.exists(path)
    assert session.release_tables(spark) == 1 and not os.path.exists(path) and session.release_tables(spark) == 0
