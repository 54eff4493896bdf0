"""Output contract per registered query: decimals kept for double columns
(default 6).  Shared by the Spark catalog and the SQL oracle."""

WINDOWS = (5, 10, 20, 60)
BAR_DIG = {"open": 4, "high": 4, "low": 4, "close": 4, "volume": 2}

DIGITS: dict[str, dict[str, int]] = {
    "daily_bars": dict(BAR_DIG),
    "ticker_summary": {"mean_close": 4, "last_ma_20": 4, "last_std_20": 4},
    "technical_indicators": {**BAR_DIG, "SMA": 3, "EMA": 3, "MACD": 3, "MACD_Signal": 3,
                             "MACD_Diff": 3, "BB_High": 3, "BB_Low": 3, "RSI": 4, "Stoch": 4,
                             "Stoch_Signal": 4, "Volume_SMA": 4},
    "price_features": {**BAR_DIG,
                       **{f"{p}_{n}d": 3 for n in WINDOWS for p in ("MA", "Std", "Max", "Min", "ATR")},
                       "High_Low": 4, "High_PrevClose": 4, "Low_PrevClose": 4, "True_Range": 4},
    "volume_features": {**BAR_DIG, **{f"Volume_MA_{n}d": 3 for n in WINDOWS}, "OBV": 2},
}


def digits(name: str) -> dict[str, int]:
    return DIGITS.get(name, {})

DIGITS.update({
    "brand_weekly_bars": dict(BAR_DIG),
    "price_panel": dict(BAR_DIG),
    "backtest": {"value": 4, "cost": 4, "max_value": 4},
    "equal_weight_benchmark": {"value": 4, "cost": 4, "max_value": 4},
    "performance_core": {"final_value": 4, "total_return": 4, "avg_cost": 4},
    "benchmark_compare": {"final_value": 4, "bench_final_value": 4, "total_return": 4,
                          "bench_total_return": 4, "outperformance": 4},
    "quick_eval": {"final_value": 4, "total_return": 4},
    "model_gate": {"total_return": 4},
})

DIGITS.update({
    "hourly_event_bars": dict(BAR_DIG),
    "clean_event_bars": dict(BAR_DIG),
    "chrono_split": dict(BAR_DIG),
    "interpolated_panel": dict(BAR_DIG),
    "latest_window": dict(BAR_DIG),
})

DIGITS.update({
    "asof_market": {**BAR_DIG, "m_close": 4},
    "market_features": {**BAR_DIG, "m_close": 4},
})

DIGITS.update({
    "latest_model": {"metric": 2},
    "best_model": {"metric": 2},
})

DIGITS.update({"window_stats": {"mean": 4, "std": 4, "last": 4}})

DIGITS.update({
    "describe_bars": {"mean": 4, "std": 4, "min": 4, "max": 4, "p25": 4, "p50": 4, "p75": 4},
    "array_stats_panel": {"mean": 4, "std": 4, "min": 4, "max": 4},
    "rolling_report": {"rolling_annual_return": 4, "rolling_volatility": 4},
    "feature_tensor": {"value": 4},
    "feature_stack": {**DIGITS["technical_indicators"], **DIGITS["price_features"],
                      **DIGITS["volume_features"]},
})

DIGITS.update({"stream_hourly_bars": dict(BAR_DIG)})

DIGITS.update({"backtest_open_drift": DIGITS["backtest"]})

DIGITS.update({f"{c}_category": DIGITS["feature_stack"] for c in ("price", "volume", "technical")})

DIGITS.update({
    "portfolio_gauges": {"value": 4, "total_return_percentage": 4},
    "portfolio_alerts": {"peak_value": 4},
    "backtest_training_progress": {"mean_value": 4},
    "backtest_training_summary": {"first_value": 4, "final_value": 4, "total_return": 4},
    "runs_with_versions": {"metric": 2},
    "model_info": {"metric": 2},
})

DIGITS.update({"allocation_features": {f"{f}_{s}": 4 for f in ("open", "high", "low", "close", "volume")
                                       for s in ("mean", "std", "last")}})
