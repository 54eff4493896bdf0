"""E5–E9, E11, F34–F38 — performance reports over return series.

All reports are ``groupBy(series)`` aggregates (partial aggregation before the
shuffle) or windows partitioned by series over *steps*, whose count per series
is bounded by the back-test calendar.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.core import UNB, full, series_window, td

SQRT252 = math.sqrt(252.0)


def daily_returns(bars: DataFrame, key="ticker", order="date", close="close") -> DataFrame:
    w = series_window(key, order)
    return bars.withColumn("ret", td(F.col(close), F.lag(close).over(w)) - 1)


def ticker_summary(bars: DataFrame, ma_window: int = 20) -> DataFrame:
    """E9 plus the minimal feature slice: per ticker mean close, mean and sample
    std of the daily return (in %), and the last ``MA``/``Std`` of the close."""
    w = series_window()
    c = F.col("close")
    feat = bars.select(
        "ticker", "date", "close",
        (td(c, F.lag(c).over(w)) - 1).alias("ret"),
        full(F.avg(c), c, w, ma_window).alias("ma"),
        full(F.stddev_samp(c), c, w, ma_window).alias("sd"),
    )
    return feat.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.avg("close").alias("mean_close"),
        (F.avg("ret") * 100).alias("mean_return_pct"),
        (F.stddev_samp("ret") * 100).alias("std_return_pct"),
        F.max_by("ma", "date").alias(f"last_ma_{ma_window}"),
        F.max_by("sd", "date").alias(f"last_std_{ma_window}"),
    )


def _sample_skew(m):
    """Bias-corrected skewness from Spark's population skewness and count."""
    n = F.count(m)
    g1 = F.skewness(m)
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def _sample_kurt(m):
    """Bias-corrected excess kurtosis (pandas ``kurt``)."""
    n = F.count(m)
    g2 = F.kurtosis(m)
    return F.when(n > 3, ((n - 1) / ((n - 2) * (n - 3))) * ((n + 1) * g2 + 6))


def performance_core(bt: DataFrame, key: str = "portfolio_id", v0: float = 10000.0) -> DataFrame:
    """E5: total / annualised return, annual volatility, Sharpe, max drawdown,
    average cost, cumulative reward — one row per series."""
    ann = (F.pow(1 + F.avg("ret"), 252) - 1) * 100
    vol = F.stddev_pop("ret") * SQRT252 * 100
    return bt.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_steps"),
        ((F.max_by("value", "step") / F.lit(v0) - 1) * 100).alias("total_return"),
        ann.alias("annual_return"),
        vol.alias("volatility"),
        F.coalesce(td(ann, F.when(vol > 0, vol)), F.lit(0.0)).alias("sharpe"),
        (F.max("drawdown") * 100).alias("max_drawdown"),
        F.avg("cost").alias("avg_cost"),
        F.sum("reward").alias("total_reward"),
        F.avg("reward").alias("mean_reward"),
        F.max_by("value", "step").alias("final_value"),
    )


def performance_advanced(series: DataFrame, key: str = "portfolio_id", rf: float = 0.0) -> DataFrame:
    """E6 over ``drawdown_series`` output: Sortino, Calmar (report convention:
    drawdown ≤ 0), skewness and excess kurtosis (bias-corrected, as pandas)."""
    r = F.col("ret")
    down = F.when(r < rf, r)
    ann_raw = F.pow(1 + F.avg(r), 252) - 1
    dd_pct = F.min("drawdown") * 100
    sd_down = F.stddev_pop(down)
    g = series.groupBy(key).agg(
        F.when((F.count(down) > 0) & (sd_down > 0), (ann_raw - rf) / (sd_down * SQRT252))
        .otherwise(F.lit(0.0)).alias("sortino"),
        F.when(dd_pct != 0, -ann_raw / (dd_pct / 100)).otherwise(F.lit(0.0)).alias("calmar"),
        dd_pct.alias("max_drawdown_pct"),
        _sample_skew(r).alias("skewness"),
        _sample_kurt(r).alias("kurtosis"),
    )
    return g


def drawdown_series(bt: DataFrame, key: str = "portfolio_id", order: str = "step") -> DataFrame:
    """cumulative return Π(1+r)−1 and drawdown (cum−runmax)/runmax ≤ 0
    computed on the wealth index 1+cum."""
    w = series_window(key, order)
    u = w.rowsBetween(UNB, 0)
    wealth = F.product(1 + F.col("ret")).over(u)
    df = bt.select(key, order, "ret", wealth.alias("wealth"))
    peak = F.max("wealth").over(u)
    return df.select(key, order, "ret", (F.col("wealth") - 1).alias("cumulative_return"),
                     td(F.col("wealth") - peak, peak).alias("drawdown"))



def benchmark_compare(model: DataFrame, bench: DataFrame, key: str = "portfolio_id",
                      v0: float = 10000.0) -> DataFrame:
    """E7 (+D6): each model series against the benchmark series.

    The benchmark's summary is attached to each of its step rows with a
    whole-series window (one calendar-bounded series), then equi-joined to the
    model rows on ``step`` — no pairing of tables."""
    whole = Window.partitionBy(key)
    b = bench.select(
        "step",
        ((F.max_by("value", "step").over(whole) / v0 - 1) * 100).alias("bench_total_return"),
        ((F.pow(1 + F.avg("ret").over(whole), 252) - 1) * 100).alias("bench_annual_return"),
        (F.stddev_pop("ret").over(whole) * SQRT252 * 100).alias("bench_volatility"),
        F.max_by("value", "step").over(whole).alias("bench_final_value"))
    j = model.join(b, "step", "left")
    g = j.groupBy(key).agg(
        ((F.max_by("value", "step") / v0 - 1) * 100).alias("total_return"),
        F.max_by("value", "step").alias("final_value"),
        F.first("bench_total_return", ignorenulls=True).alias("bench_total_return"),
        F.first("bench_annual_return", ignorenulls=True).alias("bench_annual_return"),
        F.first("bench_volatility", ignorenulls=True).alias("bench_volatility"),
        F.first("bench_final_value", ignorenulls=True).alias("bench_final_value"))
    bsh = F.when(F.col("bench_volatility") > 0,
                 F.col("bench_annual_return") / F.col("bench_volatility")).otherwise(F.lit(0.0))
    return g.select("*", bsh.alias("bench_sharpe"),
                    (F.col("total_return") - F.col("bench_total_return")).alias("outperformance"),
                    td("final_value", "bench_final_value").alias("value_ratio"))


def quick_eval(bt: DataFrame, key: str = "portfolio_id", max_steps: int = 100) -> DataFrame:
    """The first ``max_steps`` steps: mean reward, total return from the
    FIRST step's value, volatility = std_pop·100, sharpe = mean/max(std, 1e-6)."""
    w = Window.partitionBy(key).orderBy("step")
    head = bt.withColumn("_i", F.row_number().over(w)).filter(F.col("_i") <= max_steps)
    sd = F.stddev_pop("ret")
    return head.groupBy(key).agg(
        F.avg("reward").alias("mean_reward"),
        ((F.max_by("value", "step") / F.min_by("value", "step") - 1) * 100).alias("total_return"),
        F.max_by("value", "step").alias("final_value"),
        (sd * 100).alias("volatility"),
        (F.avg("ret") / F.greatest(sd, F.lit(1e-6))).alias("sharpe_ratio"))


def trailing_moments(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample std of every ``n`` consecutive values (NaN before the
    n-th and where one is missing); the std of equal values is exactly zero."""
    mean, std = np.full(len(x), np.nan), np.full(len(x), np.nan)
    if 0 < n <= len(x):
        frames = sliding_window_view(x, n)
        mean[n - 1:] = frames.mean(1)
        if n > 1:
            centred = frames - mean[n - 1:, None]
            spread = np.sqrt((centred * centred).sum(1) / (n - 1))
            std[n - 1:] = np.where(frames.max(1) == frames.min(1), 0.0, spread)
    return mean, std


def rolling_report(bt: DataFrame, key: str = "portfolio_id", order: str = "step") -> DataFrame:
    """rolling annualised return (n = min(252, N//2), only when
    N > n) and rolling volatility (n = min(30, N//4)), N = series length.

    Frame lengths depend on the series, which no window frame can say, so a series
    (one calendar long) is one Arrow group: its key, order and return go in, and
    frames are views of the one array."""
    fields = [bt.schema[key], bt.schema[order], T.StructField("ret", T.DoubleType()),
              T.StructField("annual_window", T.IntegerType()), T.StructField("vol_window", T.IntegerType()),
              T.StructField("rolling_annual_return", T.DoubleType()), T.StructField("rolling_volatility", T.DoubleType())]

    def report(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        ret = table.column("ret").to_numpy().astype(np.float64)
        total = len(ret)
        na, nv = min(252, total // 2), min(30, total // 4)
        annual = trailing_moments(ret, na)[0] if total > na else np.full(total, np.nan)
        vol = trailing_moments(ret, nv)[1]
        return pa.table({
            key: table.column(key), order: table.column(order), "ret": table.column("ret"),
            "annual_window": pa.array(np.full(total, na, np.int32)), "vol_window": pa.array(np.full(total, nv, np.int32)),
            "rolling_annual_return": pa.array(annual * 252 * 100, from_pandas=True),
            "rolling_volatility": pa.array(vol * SQRT252 * 100, from_pandas=True)})

    return bt.select(key, order, F.col("ret").cast("double").alias("ret")).groupBy(key).applyInArrow(report, T.StructType(fields))


def return_histogram(bt: DataFrame, bins: int = 50, lo: float | None = None,
                     hi: float | None = None) -> DataFrame:
    """distribution of returns in % over ``bins`` equal-width bins
    between the observed min and max (two scalars from one aggregate)."""
    r = F.col("ret") * 100
    if lo is None or hi is None:
        lo, hi = bt.agg(F.min(r), F.max(r)).first()
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((r - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    g = bt.filter(F.col("ret").isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    return g.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"), "count")


def risk_ratios(core: DataFrame, rf: float = 0.02) -> DataFrame:
    """The service's ratios on E5 output — Sharpe = (annual return − rf)
    / volatility and Calmar = annual return / max drawdown (fractions)."""
    ann, vol, dd = (F.col("annual_return") / 100, F.col("volatility") / 100,
                    F.col("max_drawdown") / 100)
    return core.select("portfolio_id", td(ann - rf, vol).alias("sharpe_rf"),
                       td(ann, dd).alias("calmar_ratio"))
