"""Registered queries over the feature store, as-of joins on events, tick-grain
recurrences, fitted normalisation and pluggable models."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import backtest as G
from tickloom.operators import bars as B
from tickloom.operators import clean as C
from tickloom.operators import indicators as IND
from tickloom.operators import joins as D
from tickloom.operators import scoring as I
from tickloom.operators.feature_store import FeatureStore
from tickloom.functions.scan import tick_indicators
from tickloom.plans import market as M
from tickloom.session import materialize, scratch_path
from tickloom.sources import adapters as AD
from tickloom.sources.tables import table


# ---------------------------------------------------------------- as-of joins at second grain
def _events(spark, sf_dir) -> DataFrame:
    """Events to the second; account 0 gathers every third user, so that it
    holds a third of the rows."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.date_trunc("second", "ts").alias("ts"), "event_type", "value",
                     F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("account"))


def _purchases(events: DataFrame, *keys) -> DataFrame:
    return events.filter(F.col("event_type") == "purchase").select(
        *keys, "ts", F.col("event_id").alias("purchase_id"), F.col("value").alias("purchase_value"))


def q_asof_events(spark, sf_dir):
    """Every event with the newest purchase up to its second."""
    ev = _events(spark, sf_dir)
    return D.asof_join(ev, _purchases(ev), on="ts", tiebreak=["purchase_id"]).select(
        "event_id", "event_type", "value", "purchase_id", "purchase_value")


def q_asof_account_events(spark, sf_dir):
    """D1 by key: every event with its account's newest purchase."""
    ev = _events(spark, sf_dir)
    return D.asof_join(ev, _purchases(ev, "account"), on="ts", by="account", tiebreak=["purchase_id"]).select(
        "event_id", "account", "event_type", "value", "purchase_id", "purchase_value")


# ---------------------------------------------------------------- recurrences at tick grain
def q_tick_indicators(spark, sf_dir):
    """F2–F6 on every event; the series "system" (errors and sign-ups) holds two
    fifths of the rows."""
    ev = AD.tick_stream(spark, sf_dir).select(
        F.when(F.col("ticker").isin("error", "signup"), "system").otherwise(F.col("ticker")).alias("ticker"),
        "ts", F.col("seq.k1").alias("event_id"), "price")
    return tick_indicators(ev, order=("ts", "event_id")).select(
        "event_id", "ticker", "EMA", "MACD", "MACD_Signal", "MACD_Diff", "RSI")


# ---------------------------------------------------------------- feature store
def _returns(bars: DataFrame) -> DataFrame:
    f = IND.add_price_features(bars, windows=(5,), backfill=False)
    return f.select("ticker", "date", "close", "Daily_Return", "MA_5d", "Std_5d")


def _volumes(bars: DataFrame) -> DataFrame:
    f = IND.add_volume_features(bars, windows=(5,), backfill=False)
    return f.select("ticker", "date", "Volume_Change", "Volume_MA_5d")


def _store(spark) -> FeatureStore:
    return FeatureStore(spark, scratch_path(spark, f"feature_store/{uuid.uuid4().hex}"))


def q_feature_store_round_trip(spark, sf_dir):
    """H2, H3, H6: weekly returns of brands with an even last digit are stored;
    all brands are asked for, so the others are computed and added; asking again,
    and storing the same rows again, commits nothing.  ``commits`` counts."""
    bars = M.materialized_brand_bars(spark, sf_dir)
    keys = ["ticker", "date"]
    store = _store(spark)
    even = bars.filter(F.substring("ticker", -1, 1).cast("int") % 2 == 0)
    ident = store.save(_returns(even), "weekly_returns", keys, "brand", parameters={"window": 5})

    def asked():
        return store.get_or_compute(bars.select("ticker"), lambda missing: _returns(bars.join(missing, "ticker", "left_semi")),
                                    "weekly_returns", keys, "brand", parameters={"window": 5})

    asked()
    rows = asked()
    _, commits = store.upsert(rows, "weekly_returns", keys, "brand", parameters={"window": 5})
    stored = store.load(feature_id=ident)
    return stored.withColumn("commits", F.lit(commits))


def _filled_store(spark, sf_dir) -> FeatureStore:
    bars = M.materialized_brand_bars(spark, sf_dir)
    store, keys = _store(spark), ["ticker", "date"]
    ids = [store.save(_returns(bars), "returns", keys, "brand", parameters={"window": 5}),
           store.save(_volumes(bars), "volumes", keys, "brand", parameters={"window": 5, "kind": "weekly"})]
    store.save_set("brand_features", ids)
    return store


def q_feature_set_data(spark, sf_dir):
    """H4: a feature set's data, its two members side by side."""
    return _filled_store(spark, sf_dir).load_set("brand_features")


def q_feature_listing(spark, sf_dir):
    """H5: the stored features with parsed parameters and statistics."""
    rows = _filled_store(spark, sf_dir).list_features(entity_type="brand")
    first = F.when(F.col("name") == "returns", "close").otherwise("Volume_MA_5d")
    return rows.select("id", "name", "version", F.col("parameters")["window"].alias("window"),
                       F.col("stats.shape")[0].alias("n_rows"), F.size("stats.columns").alias("n_columns"),
                       F.col("stats.description")[first]["mean"].alias("mean_of_first"),
                       F.col("stats.description")[first]["std"].alias("std_of_first"), "commit")


# ---------------------------------------------------------------- fitted normalisation
def q_normalized_split(spark, sf_dir):
    """Daily bars, normalised by what their training rows tell."""
    bars = materialize(B.ohlcv_bars(AD.ticks(spark, sf_dir), "day"), "daily_bars")
    split = C.chrono_split(bars, ratio=0.7)
    fitted = C.fit_normalizer(split.filter(F.col("split") == "train"))
    return C.apply_normalizer(split, fitted).select("ticker", "date", "split", *C.OHLCV)


# ---------------------------------------------------------------- pluggable model
class LinearModel:
    """A fixed linear map of one observation window to a score: lag k of a
    feature weighs k / n, a feature weighs by its place among ``features``."""

    def __init__(self, features, n: int):
        import numpy as np
        self.weights = np.outer(1.0 + np.arange(len(features)), (1.0 + np.arange(n)) / n).ravel()

    def predict(self, tensors):
        return tensors @ self.weights


def q_model_scores(spark, sf_dir):
    """N2 over B12: a model scores every observation window of the panel."""
    features, n = ("close", "volume"), 10
    tensors = C.observation_tensors(M.price_panel(spark, sf_dir), n=n, features=features)
    return I.score_windows(tensors, lambda: LinearModel(features, n))


# ---------------------------------------------------------------- allocation
def q_allocation_features(spark, sf_dir):
    """Window statistics beside every portfolio's current weights."""
    bb = M.materialized_brand_bars(spark, sf_dir)
    current = I.current_weights(G.normalize_weights(M.portfolio_actions(spark, sf_dir, bb)))
    return I.allocation_features(I.window_stats(M.price_panel(spark, sf_dir, bb), n=30), current)


def q_equal_allocations(spark, sf_dir):
    """Equal weights over every brand, held or not."""
    bb = M.materialized_brand_bars(spark, sf_dir)
    current = I.current_weights(G.normalize_weights(M.portfolio_actions(spark, sf_dir, bb)))
    return I.score_portfolios(current, policy="equal", universe=bb.select("ticker").distinct())


RAW = {
    "allocation_features": q_allocation_features,
    "equal_allocations": q_equal_allocations,
    "asof_events": q_asof_events,
    "asof_account_events": q_asof_account_events,
    "tick_indicators": q_tick_indicators,
    "feature_store_round_trip": q_feature_store_round_trip,
    "feature_set_data": q_feature_set_data,
    "feature_listing": q_feature_listing,
    "normalized_split": q_normalized_split,
    "model_scores": q_model_scores,
}
