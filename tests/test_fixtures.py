"""Hand-written fixtures (FIXTURES.md) with hand-computed results."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickloom.operators import backtest as G
from tickloom.operators import clean as C
from tickloom.operators import indicators as IND

D0 = dt.date(2024, 1, 1)


def bars_of(spark, closes, ticker="T", volume=5000.0):
    rows = [(ticker, D0 + dt.timedelta(days=i), c, c, c, c, volume) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, date date, open double, high double, "
                                       "low double, close double, volume double")


def col(df, c, order="date"):
    return [r[0] for r in df.orderBy(order).select(c).collect()]


def test_gap_prices(spark):
    df = bars_of(spark, [0.0, 10.0, 0.0, 0.0, 16.0, None, 20.0, -1.0])
    out = C.repair_prices(C.sanitize(df))
    assert col(out, "close") == [10.0, 10.0, 13.0, 13.0, 16.0, 18.0, 20.0, 20.0]


def test_all_bad(spark):
    df = bars_of(spark, [0.0, None, -3.0], volume=5.0)
    out = C.clean_bars(df)
    assert col(out, "close") == [100.0, 100.0, 100.0]
    assert col(out, "volume") == [1000.0, 1000.0, 1000.0]


def test_rebase_and_scale(spark):
    df = bars_of(spark, [0.0, 4.0, 8.0])
    out = C.normalize_bars(df)
    assert col(out, "close") == [0.0, 1.0, 2.0]
    assert col(out, "volume") == [1.0, 1.0, 1.0]


def test_tie_bars(spark):
    from tickloom.operators.bars import ohlcv_bars
    ts = dt.datetime(2024, 1, 1, 10, 0)
    rows = [("T", ts, 5.0, 1.0, (2,)), ("T", ts, 7.0, 2.0, (1,))]
    t = spark.createDataFrame(rows, "ticker string, ts timestamp, price double, volume double, "
                                    "seq struct<k1:int>")
    b = ohlcv_bars(t, "hour").first()
    assert (b.open, b.close, b.volume) == (7.0, 5.0, 3.0)


def test_constant_series(spark):
    df = bars_of(spark, [10.0] * 20)
    t = IND.add_technical_indicators(df, backfill=False).orderBy("date").collect()
    assert t[19].RSI == 100.0 and t[12].RSI is None and t[13].RSI == 100.0
    p = IND.add_price_features(df, backfill=False).orderBy("date").collect()
    assert p[4]["Std_5d"] == 0.0 and p[3]["Std_5d"] is None
    two = df.unionByName(bars_of(spark, [3.0] * 20, ticker="U"))
    partners = spark.createDataFrame([("T", "U")], "ticker string, other string")
    corr = IND.add_correlation_features(two, partners, windows=(10,), backfill=False)
    assert corr.count() == 20
    assert all(r.Corr_10d is None for r in corr.collect())


def test_interpolate_edges(spark):
    df = bars_of(spark, [None, 2.0, None, None, 8.0, None])
    out = col(C.interpolate_edges(df, cols=("close",)), "close")
    # f = first valid index (1, value 2); k=2,3 with next valid m=4 (8): 2(1-ρ)+8ρ
    assert out == [2.0, 2.0, 2.0 * (1 - 1 / 3) + 8.0 / 3, 2.0 * (1 - 2 / 3) + 16.0 / 3, 8.0, 8.0]


def test_two_asset_path(spark):
    """Two tickers, four dates, one full rotation, cost 1 %, by hand."""
    prices = spark.createDataFrame(
        [("A", 0, 10.0), ("A", 1, 11.0), ("A", 2, 11.0), ("A", 3, 12.1),
         ("B", 0, 20.0), ("B", 1, 20.0), ("B", 2, 10.0), ("B", 3, 10.0)],
        "ticker string, step int, close double")
    acts = spark.createDataFrame([("p", 1, "A", 1.0), ("p", 2, "B", 1.0)],
                                 "portfolio_id string, step int, ticker string, raw double")
    prm = G.BacktestParams(window=1, cost=0.01, stop_fraction=0.0)
    out = G.backtest(prices, acts, prm).orderBy("step").collect()
    # step 1: old = equal, new = A; growth = .5*1 + .5*.5 − .01*1 = 0.74
    # step 2: old = A, new = B;      growth = 1.1 − .01*2 = 1.08
    assert [r.step for r in out] == [2, 3]
    assert math.isclose(out[0].value, 10000 * 0.74)
    assert math.isclose(out[1].value, 10000 * 0.74 * 1.08)
    assert math.isclose(out[0].cost, 10000 * 0.01 * 1.0)


def test_weights_normalisation(spark):
    acts = spark.createDataFrame(
        [("p", 0, "A", float("nan")), ("p", 0, "B", 0.5), ("q", 0, "A", -0.5), ("q", 0, "B", 1.0),
         ("r", 0, "A", 0.0), ("r", 0, "B", 0.0)],
        "portfolio_id string, step int, ticker string, raw double")
    w = {(r.portfolio_id, r.ticker): r.weight for r in G.normalize_weights(acts).collect()}
    # p: NaN -> equal (implicit, no rows); q: negatives -> 0; r: all zero -> equal
    assert w == {("q", "B"): 1.0}


def test_window_guard(spark):
    with pytest.raises(ValueError):
        G.step_range(5, 10)
    assert G.step_range(31, 30) == (30, 30)
    assert G.step_range(100, 30) == (30, 98)


def test_late_tick(spark, tmp_path):
    """A tick older than the watermark is dropped; one inside it is merged.

    Spark filters late rows against the watermark of the previous
    micro-batch, so the late tick arrives in the third file."""
    import time
    from tickloom.streaming import ticks as K
    src = tmp_path / "in"
    src.mkdir()
    sch = "ticker string, ts timestamp, price double, volume double, seq struct<k1:int>"
    t = dt.datetime
    files = [
        [("T", t(2024, 1, 1, 10, 5), 1.0, 1.0, (1,)), ("T", t(2024, 1, 1, 12, 30), 2.0, 1.0, (2,))],
        [("T", t(2024, 1, 1, 12, 10), 3.0, 1.0, (3,)), ("T", t(2024, 1, 1, 15, 0), 5.0, 1.0, (5,))],
        [("T", t(2024, 1, 1, 10, 50), 4.0, 1.0, (4,)), ("T", t(2024, 1, 1, 15, 10), 6.0, 1.0, (6,))],
    ]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, sch).coalesce(1).write.parquet(str(src / f"b{i}"))
        time.sleep(1.1)
    stream = spark.readStream.schema(sch).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(str(src))
    out = tmp_path / "out"
    K.drain(K.bars_stream(stream, "1 hour", "30 minutes"), str(out), str(tmp_path / "ck"))
    got = {(r.hour, r.n_ticks, r.open, r.close)
           for r in spark.read.parquet(str(out)).collect()}
    assert got == {(10, 1, 1.0, 1.0), (12, 2, 3.0, 2.0)}
