"""DuckDB oracle for window statistics and allocation scoring."""

from __future__ import annotations

from tickloom.plans.contracts import digits
from tickloom.plans.oracle_market import BRAND
from tickloom.plans.rounding import round_sql

SCORED = f"""{BRAND},
vol AS (SELECT ticker, stddev_pop(rel - 1) AS vol FROM (
          SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY step DESC) AS k FROM rel) WHERE k <= 30
        GROUP BY ticker),
lastw AS (SELECT portfolio_id, max(step) AS step FROM wpos GROUP BY portfolio_id),
cur AS (SELECT w.portfolio_id, w.ticker, w.weight FROM wpos w JOIN lastw l ON w.portfolio_id = l.portfolio_id AND w.step = l.step),
raw AS (SELECT c.portfolio_id, c.ticker, c.weight AS current_weight,
          CASE WHEN v.vol > 1e-8 THEN 1.0 / v.vol ELSE 0.0 END AS raw FROM cur c LEFT JOIN vol v ON c.ticker = v.ticker),
sc AS (SELECT portfolio_id, ticker, current_weight,
         CASE WHEN sum(greatest(raw, 0.0)) OVER (PARTITION BY portfolio_id) > 1e-8
              THEN greatest(raw, 0.0) / sum(greatest(raw, 0.0)) OVER (PARTITION BY portfolio_id)
              ELSE 1.0 / count(*) OVER (PARTITION BY portfolio_id) END AS new_weight
       FROM raw)"""


def q_window_stats():
    feats = ("open", "high", "low", "close", "volume")
    unions = " UNION ALL ".join(f"SELECT ticker, step, '{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM l" for f in feats)
    inner = f"""WITH {BRAND},
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY step DESC) AS k FROM panel) WHERE k <= 30),
lg AS ({unions})
SELECT ticker, feature, avg(x) AS mean, stddev_pop(x) AS std, arg_max(x, step) AS last FROM lg GROUP BY ticker, feature"""
    return round_sql(inner, ["ticker", "feature", "mean", "std", "last"], {"mean", "std", "last"},
                     digits("window_stats"))


def q_score_allocations():
    inner = f"""WITH {SCORED} SELECT portfolio_id, ticker, current_weight, new_weight,
  new_weight - coalesce(current_weight, 0.0) AS change FROM sc"""
    return round_sql(inner, ["portfolio_id", "ticker", "current_weight", "new_weight", "change"],
                     {"current_weight", "new_weight", "change"})


def q_rebalance_decisions():
    inner = f"""WITH {SCORED},
g AS (SELECT portfolio_id, count(*) AS n_assets, sum(new_weight * ln(new_weight + 1e-8)) AS plogp,
             max(abs(new_weight - coalesce(current_weight, 0.0))) AS max_change,
             sum(abs(new_weight - coalesce(current_weight, 0.0))) AS total_change, sum(new_weight) AS weight_sum
      FROM sc GROUP BY portfolio_id)
SELECT portfolio_id, n_assets,
  1 - CASE WHEN u.n = 1 THEN NULL ELSE -plogp / ln(u.n) END AS confidence,
  max_change, total_change, weight_sum, max_change > 0.05 AS rebalance_needed,
  total_change > 0.05 AS rebalance_needed_total FROM g, (SELECT count(DISTINCT ticker) AS n FROM panel) u"""
    cols = ["portfolio_id", "n_assets", "confidence", "max_change", "total_change", "weight_sum",
            "rebalance_needed", "rebalance_needed_total"]
    return round_sql(inner, cols, {"confidence", "max_change", "total_change", "weight_sum"})


def q_weight_validation():
    inner = f"""WITH {SCORED} SELECT portfolio_id, sum(weight) AS weight_sum, count(*) AS n_assets,
  abs(sum(weight) - 1) <= 0.01 AS valid FROM cur GROUP BY portfolio_id"""
    return round_sql(inner, ["portfolio_id", "weight_sum", "n_assets", "valid"], {"weight_sum"})


ORACLE = {
    "window_stats": q_window_stats,
    "score_allocations": q_score_allocations,
    "rebalance_decisions": q_rebalance_decisions,
    "weight_validation": q_weight_validation,
}
