"""Indicator stages against pandas rolling/ewm on real series (sf0.001)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions.recurrence import ema_frame
from tickloom.operators import indicators as IND
from tickloom.plans.catalog import daily_bars

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def series(spark):
    b = daily_bars(spark, SF)
    keep = [r[0] for r in b.groupBy("ticker").count().orderBy(F.desc("count"), "ticker").limit(2).collect()]
    return b.filter(F.col("ticker").isin(keep))


def _close(a, b, tol=1e-9):
    a, b = np.asarray(a, float), np.asarray(b, float)
    assert (np.isnan(a) == np.isnan(b)).all()
    m = ~np.isnan(a)
    assert np.allclose(a[m], b[m], rtol=tol, atol=tol)


def test_price_features_vs_pandas(series):
    got = IND.add_price_features(series, backfill=False).toPandas()
    for _, g in got.groupby("ticker"):
        g = g.sort_values("date")
        c = g["close"]
        _close(g["MA_20d"], c.rolling(20).mean())
        _close(g["Std_10d"], c.rolling(10).std())
        _close(g["Max_60d"], c.rolling(60).max())
        _close(g["Return_5d"], c.pct_change(5))
        tr = pd.concat([g["high"] - g["low"], (g["high"] - c.shift()).abs(),
                        (g["low"] - c.shift()).abs()], axis=1).max(axis=1)
        _close(g["ATR_10d"], tr.rolling(10).mean())


def test_volume_and_technical_vs_pandas(series):
    v = IND.add_volume_features(series, backfill=False).toPandas()
    t = IND.add_technical_indicators(series, backfill=False).toPandas()
    for (_, gv), (_, gt) in zip(v.groupby("ticker"), t.groupby("ticker")):
        gv, gt = gv.sort_values("date"), gt.sort_values("date")
        c, vol = gv["close"], gv["volume"]
        _close(gv["OBV"], (np.sign(c.diff()) * vol).fillna(0).cumsum())
        _close(gv["Volume_Ratio_5d"], vol / vol.rolling(5).mean())
        ref = ema_frame(gt["close"].reset_index(drop=True))
        _close(gt["EMA"], ref["EMA"])
        _close(gt["RSI"], ref["RSI"])
        _close(gt["Volatility"], gt["close"].pct_change().rolling(30).std() * np.sqrt(252))


def test_metrics_stream(spark, tmp_path):
    """K6: sliding 5-minute request/error rates on a file stream equal the
    batch result for windows the watermark has closed."""
    from tickloom.operators import monitoring as J
    from tickloom.sources import adapters as AD
    from tickloom.streaming import ticks as K
    log = AD.api_log(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    src = tmp_path / "in"
    log.write.parquet(str(src))
    stream = spark.readStream.schema(log.schema).parquet(str(src))
    out = tmp_path / "out"
    K.drain(K.metrics_stream(stream), str(out), str(tmp_path / "ck"))
    got = spark.read.parquet(str(out))
    batch = J.sliding_rates(log)
    wm = log.agg(F.max("ts")).first()[0]
    import datetime as dt
    closed = batch.filter(F.col("window_end") <= F.lit(wm - dt.timedelta(minutes=10)))
    a = {(r.window_start, r.endpoint, r.requests, r.errors) for r in got.collect()}
    b = {(r.window_start, r.endpoint, r.requests, r.errors) for r in closed.collect()}
    assert a == b and len(a) > 0
