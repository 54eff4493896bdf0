"""I1–I4, E4 — batch allocation scoring over a table of portfolios.

Built-in policies are column math (equal, hold, inverse volatility over the
held assets); a user model plugs in as a grouped pandas function whose group
is one portfolio's asset rows (bounded by the universe size).
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.core import td


def window_stats(panel: DataFrame, n: int = 30, features=("open", "high", "low", "close", "volume"),
                 key: str = "ticker", order: str = "step") -> DataFrame:
    """Per asset × feature over the last ``n`` periods: mean, population
    std and last value (long form)."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    last = panel.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= n)
    st = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x"))
                             for f in features])).alias("_f")
    long = last.select(key, order, st).select(key, order, "_f.feature", "_f.x")
    return long.groupBy(key, "feature").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"),
        F.max_by("x", order).alias("last"))


def allocation_features(stats: DataFrame, current: DataFrame, key: str = "portfolio_id") -> DataFrame:
    """E4 as a model sees it: a portfolio's assets with their window statistics, one
    column per (feature, statistic), beside the current weight."""
    features = ("open", "high", "low", "close", "volume")
    wide = stats.groupBy("ticker").agg(*[
        F.max(F.when(F.col("feature") == f, F.col(s))).alias(f"{f}_{s}") for f in features for s in ("mean", "std", "last")])
    return current.select(key, "ticker", F.col("weight").alias("current_weight")).join(wide, "ticker", "left")


def asset_volatility(rel: DataFrame, n: int = 30, key: str = "ticker") -> DataFrame:
    """Population std of the last ``n`` price relatives per asset."""
    w = Window.partitionBy(key).orderBy(F.col("step").desc())
    last = rel.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= n)
    return last.groupBy(key).agg(F.stddev_pop(F.col("rel") - 1).alias("vol"))


def postprocess_weights(w: DataFrame, key: str = "portfolio_id", col: str = "raw") -> DataFrame:
    """Clip at 0 and renormalise per portfolio (equal weights when all 0)."""
    g = Window.partitionBy(key)
    pos = F.greatest(F.col(col), F.lit(0.0))
    s = F.sum(pos).over(g)
    n = F.count(F.lit(1)).over(g)
    return w.withColumn("weight", F.when(s > 1e-8, pos / s).otherwise(F.lit(1.0) / n))


def score_portfolios(current: DataFrame, vol: DataFrame | None = None, policy="inverse_vol",
                     key: str = "portfolio_id", schema: str | None = None,
                     universe: DataFrame | None = None) -> DataFrame:
    """New weights per (portfolio, ticker) for the held assets; with
    ``universe(ticker)``, a bounded list of assets, ``equal`` spreads over all of
    them, held or not.

    ``policy``: ``equal``, ``hold`` (keep current weights), ``inverse_vol``
    (∝ 1/σ over held assets; needs ``vol(ticker, vol)``; an asset whose σ is
    unknown or zero gets nothing, all such assets equal weights), or a callable
    ``pandas.DataFrame -> pandas.DataFrame`` applied per portfolio, which must
    return ``(portfolio_id, ticker, raw)``."""
    if callable(policy):
        raw = current.groupBy(key).applyInPandas(
            policy, schema or f"{key} string, ticker string, raw double")
        raw = raw.join(current, [key, "ticker"], "left")
    elif policy == "equal" and universe is not None:
        assets = universe.agg(F.collect_set("ticker").alias("_all"))
        every = current.select(key).distinct().withColumn("_k", F.lit(1)).join(assets.withColumn("_k", F.lit(1)), "_k")
        raw = every.select(key, F.explode("_all").alias("ticker")).join(current, [key, "ticker"], "left") \
            .withColumn("raw", F.lit(1.0))
    elif policy == "equal":
        raw = current.withColumn("raw", F.lit(1.0))
    elif policy == "hold":
        raw = current.withColumn("raw", F.col("weight"))
    elif policy == "inverse_vol":
        if vol is None:
            raise ValueError("inverse_vol needs an asset volatility table")
        raw = current.join(vol, "ticker", "left").withColumn(
            "raw", F.when(F.col("vol") > 1e-8, F.lit(1.0) / F.col("vol")).otherwise(F.lit(0.0)))
    else:
        raise ValueError(f"unknown policy {policy!r}")
    out = postprocess_weights(raw.withColumnRenamed("weight", "current_weight"), key)
    return out.select(key, "ticker", "current_weight", F.col("weight").alias("new_weight"),
                      (F.col("weight") - F.coalesce(F.col("current_weight"), F.lit(0.0)))
                      .alias("change"))


def score_requests(checked: DataFrame, close: int = 0, key: str = "portfolio_id", data: str = "market_data",
                   weights: str = "weights") -> DataFrame:
    """C3 → I1: inverse-volatility weights for the valid rows of
    ``validate_requests``, one row per (request, asset position from 0) with
    status ``success``.  A rejected request, or one in which no asset has a
    volatility (status ``error``), keeps one row with its reason.

    Volatility is the population std of the period returns of feature
    ``close``.  All arithmetic stays inside a request's arrays, so no request is
    shuffled."""
    def std(x):
        n = F.size(x)
        mean = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / n
        return F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)) / n)

    def returns(x):
        last = F.size(x) - 1
        return F.filter(F.zip_with(F.slice(x, 1, last), F.slice(x, 2, last), lambda a, b: F.try_divide(b, a) - 1),
                        lambda r: r.isNotNull())

    def inverse(x):
        r = F.when(F.size(x) > 1, returns(x))
        return F.when(F.size(r) > 0, F.when(std(r) > 1e-8, F.lit(1.0) / std(r)))

    series = F.try_element_at(F.col(data), F.lit(close + 1))
    df = checked.withColumn("_raw", F.when(F.col("valid"), F.transform(series, inverse)))
    total = F.aggregate(F.col("_raw"), F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))
    df = df.withColumn("_total", total)
    scored = F.col("valid") & (F.col("_total") > 0)
    status = F.when(~F.col("valid"), "rejected").when(scored, "success").otherwise("error")
    reason = F.when(F.col("valid") & ~scored, "no asset has a volatility").otherwise(F.col("reason"))
    parts = F.when(scored, F.transform(F.col("_raw"), lambda v, i: F.struct(
        i.alias("asset"), F.get(F.col(weights), i).alias("current_weight"),
        (F.coalesce(v, F.lit(0.0)) / F.col("_total")).alias("new_weight"))))
    out = df.select(key, status.alias("status"), reason.alias("reason"), F.explode_outer(parts).alias("_p"))
    return out.select(key, "status", "reason", "_p.asset", "_p.current_weight", "_p.new_weight",
                      (F.col("_p.new_weight") - F.col("_p.current_weight")).alias("change"))


def rebalance_decisions(scored: DataFrame, key: str = "portfolio_id",
                        threshold: float = 0.05, universe: int | None = None) -> DataFrame:
    """I3 + I4: allocation confidence 1 − H(w)/ln N and the rebalance call
    (max |Δw| > 0.05; the Σ|Δw| variant alongside).  N is ``universe``, the
    number of assets a portfolio can hold; by default those it holds."""
    w = F.col("new_weight")
    n = F.col("n_assets") if universe is None else F.lit(universe)
    g = scored.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_assets"),
        F.sum(w * F.log(w + 1e-8)).alias("_plogp"),
        F.max(F.abs("change")).alias("max_change"),
        F.sum(F.abs("change")).alias("total_change"),
        F.sum(w).alias("weight_sum"))
    conf = 1 - td(-F.col("_plogp"), F.log(n.cast("double")))
    return g.select(key, "n_assets", conf.alias("confidence"), "max_change", "total_change",
                    "weight_sum", (F.col("max_change") > threshold).alias("rebalance_needed"),
                    (F.col("total_change") > threshold).alias("rebalance_needed_total"))


def current_weights(actions_norm: DataFrame, key: str = "portfolio_id") -> DataFrame:
    """Each portfolio's newest explicit weights (its last action step)."""
    last = actions_norm.groupBy(key).agg(F.max("step").alias("step"))
    return actions_norm.join(last, [key, "step"], "left_semi") \
        .select(key, "ticker", "weight")


def apply_model(current: DataFrame, model: Callable, key: str = "portfolio_id") -> DataFrame:
    """A pluggable ``predict(pdf) -> pdf`` model, run per portfolio."""
    return score_portfolios(current, policy=model, key=key)


def score_windows(tensors: DataFrame, load: Callable, key="ticker", order="step") -> DataFrame:
    """A model's score of every observation tensor (``observation_tensors``).

    ``load()`` returns an object with ``predict(matrix) -> vector`` and runs once
    per Python worker, however many tasks and batches that worker gets; rows
    cross in Arrow batches and only (key, order, score) come back."""
    token = f"model_{uuid.uuid4().hex}"
    kept = [tensors.schema[c] for c in (key, order)]

    def run(frames):
        import numpy as np
        import pandas as pd
        models = sys.modules.setdefault("_tickloom_models", types.ModuleType("_tickloom_models")).__dict__
        if token not in models:
            models[token] = load()
        for pdf in frames:
            if len(pdf):
                scores = np.asarray(models[token].predict(np.stack(pdf["tensor"].to_numpy())), dtype="float64")
                yield pd.DataFrame({key: pdf[key], order: pdf[order], "score": scores})

    from pyspark.sql import types as T
    return tensors.select(key, order, "tensor").mapInPandas(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))
