"""A6, B10, C1–C6 — data-quality gates as single aggregates.

Each gate is one ``agg`` (partial aggregation, one row out) plus a decision
on column names; no rows travel to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUIRED = ("open", "high", "low", "close", "volume")


def _null_cells(df: DataFrame, cols):
    terms = []
    for c in cols:
        t = df.schema[c].dataType.typeName()
        x = F.col(c)
        bad = x.isNull() | F.isnan(x) if t in ("double", "float") else x.isNull()
        terms.append(F.sum(F.when(bad, 1).otherwise(0)))
    return sum(terms[1:], terms[0]) if terms else F.lit(0)


def ingest_summary(bars: DataFrame, order: str = "date") -> DataFrame:
    """Rows, columns, missing cells, missing ratio (+ >50 % warning), date range."""
    cols = [c for c in bars.columns]
    ncols = len(cols)
    g = bars.agg(F.count(F.lit(1)).alias("n_rows"), _null_cells(bars, cols).alias("missing_cells"),
                 F.min(order).alias("start_date"), F.max(order).alias("end_date"),
                 F.countDistinct("ticker").alias("n_tickers"))
    ratio = F.try_divide(F.col("missing_cells"), F.col("n_rows") * ncols)
    return g.select("n_rows", F.lit(ncols).alias("n_cols"),
                    F.col("missing_cells").cast("long").alias("missing_cells"),
                    ratio.alias("missing_ratio"), (ratio > 0.5).alias("missing_warning"),
                    "start_date", "end_date", "n_tickers")


def validate_dataset(bars: DataFrame, features=REQUIRED, key="ticker", order="date") -> DataFrame:
    """>= 4 features, >= 2 tickers, >= 30 periods, no NaN / inf."""
    feats = [c for c in features if c in bars.columns]
    bad = None
    for c in feats:
        x = F.col(c)
        t = x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
        bad = t if bad is None else (bad | t)
    g = bars.agg(F.countDistinct(key).alias("n_tickers"), F.countDistinct(order).alias("n_periods"),
                 F.sum(F.when(bad, 1).otherwise(0)).cast("long").alias("n_invalid"))
    reason = (F.when(F.lit(len(feats)) < 4, "fewer than 4 features")
              .when(F.col("n_tickers") < 2, "fewer than 2 tickers")
              .when(F.col("n_periods") < 30, "fewer than 30 periods")
              .when(F.col("n_invalid") > 0, "NaN or infinite values"))
    return g.select(F.lit(len(feats)).alias("n_features"), "n_tickers", "n_periods", "n_invalid",
                    reason.isNull().alias("valid"), F.coalesce(reason, F.lit("ok")).alias("reason"))


def quality_gate_data(bars: DataFrame, required=REQUIRED, order="date") -> DataFrame:
    """Fail when empty, when NULL cells exceed 10 % of the ROW count, or
    when a required column is missing; ``quality_score = 1 - nulls/cells``."""
    missing = [c for c in required if c not in bars.columns]
    cols = list(bars.columns)
    g = bars.agg(F.count(F.lit(1)).alias("n_rows"), _null_cells(bars, cols).alias("n_null"),
                 F.min(order).alias("start_date"), F.max(order).alias("end_date"))
    cells = F.col("n_rows") * len(cols)
    reason = (F.when(F.col("n_rows") == 0, "empty")
              .when(F.col("n_null") > 0.1 * F.col("n_rows"), "too many missing values")
              .when(F.lit(len(missing)) > 0, F.lit("missing columns: " + ",".join(missing))))
    return g.select("n_rows", F.lit(len(cols)).alias("n_cols"),
                    F.col("n_null").cast("long").alias("n_null"), "start_date", "end_date",
                    (1 - F.try_divide(F.col("n_null"), cells)).alias("quality_score"),
                    reason.isNull().alias("passed"), F.coalesce(reason, F.lit("ok")).alias("reason"))


# Model gate thresholds (default configuration).
MODEL_GATE = {"mean_reward": 0.1, "total_return": 5.0, "sharpe": 0.5, "max_drawdown": 0.2}


def quality_gate_model(metrics: DataFrame, thresholds=MODEL_GATE) -> DataFrame:
    """Deploy when mean_reward > 0.1, total_return > 5, sharpe > 0.5 and
    max_drawdown (a fraction) < 0.2; otherwise retrain."""
    t = thresholds
    ok_r = F.col("mean_reward") > t["mean_reward"]
    ok_t = F.col("total_return") > t["total_return"]
    ok_s = F.col("sharpe") > t["sharpe"]
    ok_d = F.col("max_drawdown") < t["max_drawdown"]
    return metrics.select("*", ok_r.alias("reward_ok"), ok_t.alias("return_ok"),
                          ok_s.alias("sharpe_ok"), ok_d.alias("drawdown_ok"),
                          F.when(ok_r & ok_t & ok_s & ok_d, "deploy").otherwise("retrain")
                          .alias("decision"))


def validate_weights(weights: DataFrame, key="portfolio_id", weight="weight",
                     tol: float = 0.01) -> DataFrame:
    """C4: one row per portfolio with its weight sum and a validity flag."""
    g = weights.groupBy(key).agg(F.sum(weight).alias("weight_sum"),
                                 F.count(F.lit(1)).alias("n_assets"))
    return g.withColumn("valid", F.abs(F.col("weight_sum") - 1) <= tol)


def validate_requests(req: DataFrame, data: str = "market_data", weights: str = "weights") -> DataFrame:
    """Split requests into valid / rejected with a reason (no exceptions).
    ``data`` is feature × stock × period; ragged, empty or NULL data is not 3-D.
    ``weights`` holds one weight per stock.  A NULL field fails its own check."""
    d, w = F.col(data), F.col(weights)
    stocks = F.size(F.try_element_at(d, F.lit(1)))
    periods = F.size(F.try_element_at(F.try_element_at(d, F.lit(1)), F.lit(1)))
    cube = (F.size(d) > 0) & (stocks > 0) & (periods > 0) & F.forall(
        d, lambda f: (F.size(f) == stocks) & F.forall(f, lambda x: F.size(x) == periods))
    total = F.aggregate(w, F.lit(0.0), lambda a, x: a + x)

    def fails(ok):
        return ~F.coalesce(ok, F.lit(False))

    reason = (F.when(fails(cube), "market data must be 3-D")
              .when(fails(F.abs(total - 1) <= 0.01), "weights must sum to 1")
              .when(fails(F.size(w) == stocks), "weights length mismatch")
              .when(fails(F.col("portfolio_value") > 0), "portfolio value must be positive")
              .when(fails(F.col("risk_tolerance").between(0, 1)), "risk tolerance outside [0, 1]"))
    return req.select("*", reason.isNull().alias("valid"),
                      F.coalesce(reason, F.lit("ok")).alias("reason"))


def require_columns(df: DataFrame, cols) -> DataFrame:
    """Raise on missing columns (the reference silently returned its input)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df
