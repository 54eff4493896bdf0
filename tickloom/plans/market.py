"""Shared sub-plans: brand series, the dense price panel, portfolio actions.

Line items are re-keyed to brands at a weekly grain;
the panel is aligned to the union calendar and repaired (B1 → B2); actions
are each supplier's weekly quantity per brand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators import clean as C


def brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly OHLCV bars per brand: narrow line items meet ``part`` once, then one
    aggregate, combined before its exchange to a row per brand and week of a task.
    A part key that holds many line items is split by the skew join."""
    from tickloom.sources.tables import table
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k3"), F.col("p_brand").alias("ticker"))
    sold = li.select(F.col("l_partkey").alias("k3"), F.col("l_shipdate").alias("ts"), F.col("l_orderkey").alias("k1"),
                     F.col("l_linenumber").alias("k2"), F.col("l_quantity").alias("volume"),
                     F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"))
    key = F.when(F.col("price").isNotNull(), F.struct("ts", "k1", "k2", "k3"))
    week = F.to_date(F.date_trunc("week", "ts")).alias("date")
    return sold.join(part, "k3").groupBy("ticker", week).agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", key).alias("close"),
        F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("n_ticks"))


def traded_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker): every brand with a line item.  Of the line items only the part
    key is read, and it meets ``part`` as a semi-join."""
    from tickloom.sources.tables import table
    sold = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
    return part.join(sold, "p_partkey", "left_semi").select("ticker").distinct()


def calendar_steps(bars: DataFrame, order: str = "date") -> DataFrame:
    """(date, step): rank of each period in the distinct calendar (one
    ordered pass over the calendar, bounded by the number of periods)."""
    cal = bars.select(order).distinct()
    return cal.select(order, (F.row_number().over(Window.orderBy(order)) - 1).cast("long").alias("step"))


def materialized_brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly brand bars written once to the shared checkpoint folder.

    The panel, the calendar and the back-test read a few scalars from them
    (bounds, number of periods and assets); materialising the small
    aggregate keeps each of those from re-scanning the line items, and the
    written copy survives executor loss (reliable checkpoint, not local)."""
    from tickloom.session import materialize
    return materialize(brand_bars(spark, sf_dir), "brand_bars")


def price_panel(spark: SparkSession, sf_dir: str, bb: DataFrame | None = None) -> DataFrame:
    """(ticker, date, step, open, high, low, close, volume), dense and repaired."""
    bb = bb if bb is not None else materialized_brand_bars(spark, sf_dir)
    panel = C.dense_panel(bb, step="7 days")
    panel = C.repair_prices(C.sanitize(panel))
    return panel.join(calendar_steps(bb), "date")


def portfolio_actions(spark: SparkSession, sf_dir: str, bb: DataFrame | None = None) -> DataFrame:
    """(portfolio_id, step, ticker, raw): supplier × week × brand quantity.  Rows
    meet ``part``, then lie by portfolio, a bounded number in a task, for all that
    follows; a part key that holds many line items is split by the skew join."""
    from tickloom.session import spread
    from tickloom.sources.tables import table
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
    cal = calendar_steps(bb if bb is not None else brand_bars(spark, sf_dir))
    sold = li.select(F.col("l_suppkey").cast("string").alias("portfolio_id"), F.col("l_partkey").alias("p_partkey"),
                     F.to_date(F.date_trunc("week", "l_shipdate")).alias("date"), F.col("l_quantity").alias("q"))
    rows = sold.join(part, "p_partkey").select("portfolio_id", "date", "ticker", "q")
    a = spread(rows, li.count(), "portfolio_id").groupBy("portfolio_id", "date", "ticker").agg(F.sum("q").alias("raw"))
    return a.join(cal, "date").select("portfolio_id", "step", "ticker", "raw")


def backtest_inputs(spark: SparkSession, sf_dir: str):
    """(panel, actions, n_steps, n_assets) from one materialised bar table."""
    bb = materialized_brand_bars(spark, sf_dir)
    n_steps, n_assets = bb.agg(F.countDistinct("date"), F.countDistinct("ticker")).first()
    return price_panel(spark, sf_dir, bb), portfolio_actions(spark, sf_dir, bb), n_steps, n_assets


def market_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, close): daily volume-weighted price over all line items — the
    market series the weekly brand bars are as-of aligned to."""
    from tickloom.sources.tables import table
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("close"))
