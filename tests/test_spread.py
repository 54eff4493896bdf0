"""Work that must not grow with a series, a block or a portfolio's neighbours."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom import session
from tickloom.functions import scan, wide
from tickloom.functions.quantiles import enclosed, exact_quantiles
from tickloom.operators import backtest as G

BARS = ("high", "low", "close", "volume")


def series(sizes, seed=3):
    rng = np.random.default_rng(seed)
    n = sum(sizes)
    close = np.round(rng.uniform(5, 50, n), 2)
    close[rng.random(n) < 0.05] = np.nan
    close[:40] = 7.0
    x = {"high": close + 1, "low": close - 1, "close": close, "volume": np.floor(rng.uniform(0, 4, n))}
    ticker = [t for i, s in enumerate(sizes) for t in [None if i == 1 else f"t{i}"] * s]
    return x, ticker


def test_series_side_by_side_equal_series_alone():
    sizes = [90, 1, 70, 3, 200, 16]
    x, _ = series(sizes)
    starts = np.cumsum([0, *sizes[:-1]])
    s = wide.Series(starts, sum(sizes))
    together = {c: s.next_valid(v) for c, v in wide.wide_features(x, s=s).items()}
    for a, n in zip(starts, sizes):
        alone = wide.wide_features({c: v[a: a + n] for c, v in x.items()})
        for c, v in alone.items():
            assert np.allclose(together[c][a: a + n], wide.next_valid(v), rtol=1e-12, atol=1e-12, equal_nan=True), c


@pytest.mark.parametrize("rows,batch", [(1, 7), (64, 13), (10_000, 50)])
def test_batches_are_cut_between_series(rows, batch):
    x, ticker = series([90, 1, 70, 3, 200, 16])
    table = pa.table({"ticker": ticker, "close": x["close"]})
    cut = list(wide.whole_series(table.to_batches(batch), ["ticker"], rows))
    assert pa.concat_tables(cut).column("ticker").to_pylist() == ticker
    seen = [set(t.column("ticker").to_pylist()) for t in cut]
    assert sum(len(s) for s in seen) == len(set(ticker))


def test_blocks_grow_with_the_rows(spark, monkeypatch):
    rows = spark.range(4000).select(F.lit("a").alias("ticker"), F.col("id").alias("ts"), F.col("id").alias("seq"),
                                    (F.col("id") % 17).cast("double").alias("price"))
    want = scan.tick_indicators(rows, blocks=1).orderBy("ts").toPandas()
    sizes = []
    monkeypatch.setattr(scan, "BLOCK_ROWS", 250)
    real = session.materialize

    def written(df, name):
        out = real(df, name)
        if name == "tick_blocks":
            sizes.extend(r["count"] for r in out.groupBy("_pid").count().collect())
        return out

    monkeypatch.setattr(session, "materialize", written)
    got = scan.tick_indicators(rows).orderBy("ts").toPandas()
    assert max(sizes) < 1000 and len(sizes) > 8
    for c in ("EMA", "MACD", "MACD_Signal", "MACD_Diff", "RSI"):
        assert np.allclose(got[c].astype(float), want[c].astype(float), atol=1e-9, equal_nan=True)


def test_quantiles_order_only_the_values_around_them(spark):
    n = 50_000
    rows = spark.range(n).select(F.when(F.col("id") % 5 == 0, "few").otherwise("many").alias("column"),
                                 F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") * 7919 % n).cast("double")).alias("value"))
    limits = {(r["column"], r.q): r for r in enclosed(rows, (0.25, 0.5, 0.75), "column", "value").collect()}
    values = {k: np.array([r.value for r in rows.filter(F.col("column") == k).collect()]) for k in ("few", "many")}
    for (k, q), r in limits.items():
        assert r._low <= np.quantile(values[k], q) <= r._high
        inside = (values[k] >= r._low) & (values[k] <= r._high) & (values[k] != 0.5)
        assert inside.sum() < 0.01 * len(values[k]) and r._below == (values[k] < r._low).sum()
    for r in exact_quantiles(rows).collect():
        assert r["quantile"] == pytest.approx(np.quantile(values[r["column"]], r.q), abs=1e-9)
    # Marks that enclose nothing: all values are looked through.
    for r in exact_quantiles(rows.filter("value > 1"), (0.0, 0.5, 1.0)).collect():
        v = values[r["column"]]
        assert r["quantile"] == pytest.approx(np.quantile(v[v > 1], r.q), abs=1e-9)


@pytest.mark.parametrize("run", [G.backtest, G.backtest_open_drift])
def test_backtest_moves_portfolios_once(spark, run):
    prices = spark.range(5 * 40).select(F.concat(F.lit("t"), (F.col("id") % 5).cast("string")).alias("ticker"),
                                        F.floor(F.col("id") / 5).alias("step"), (10.0 + F.col("id") % 7).alias("open"),
                                        (10.0 + F.col("id") % 11).alias("close"))
    acts = spark.range(900).select(F.when(F.col("id") % 9 != 0, (F.col("id") % 9).cast("string")).alias("portfolio_id"),
                                   F.floor(F.col("id") / 27).alias("step"),
                                   F.when(F.col("id") % 3 != 0, F.concat(F.lit("t"), (F.col("id") % 3).cast("string"))).alias("ticker"),
                                   F.lit(1.0).alias("raw")).dropDuplicates(["portfolio_id", "step", "ticker"])
    prm = G.BacktestParams(window=3)
    out = run(prices, acts.repartition(4, "portfolio_id"), prm, n_steps=40, n_assets=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("REPARTITION_BY_NUM") == 1
    keyed = [x for x in plan.splitlines() if "Exchange hashpartitioning(portfolio_id" in x and "REPARTITION_BY_NUM" not in x]
    assert len(keyed) <= 1  # dropDuplicates'
    assert {r.portfolio_id for r in out.collect()} == {None, *map(str, range(1, 9))}
