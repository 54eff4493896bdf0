"""DuckDB oracle for the brand panel and back-test queries.

The back-test here is written the *dense* way — every portfolio × step ×
asset weight materialised, then the step recurrence's closed form — as an
independent check of the sparse Spark operator.
"""

from __future__ import annotations

from tickloom.plans.contracts import digits
from tickloom.plans.oracle import BAR_COLS, BAR_DBL, ordkey
from tickloom.plans.rounding import round_sql

PX = "PARTITION BY ticker ORDER BY step"

BRAND = f"""bt AS (
  SELECT p_brand AS ticker, l_shipdate AS ts, CAST(date_trunc('week', l_shipdate) AS DATE) AS date,
         CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS price,
         CAST(l_quantity AS DOUBLE) AS volume, l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3,
         l_suppkey AS supplier
  FROM lineitem JOIN part ON l_partkey = p_partkey),
bbars AS (
  SELECT ticker, date,
    arg_min(price, {ordkey('ts', 'k1', 'k2', 'k3')}) FILTER (WHERE price IS NOT NULL) AS open,
    max(price) AS high, min(price) AS low,
    arg_max(price, {ordkey('ts', 'k1', 'k2', 'k3')}) FILTER (WHERE price IS NOT NULL) AS close,
    sum(volume) AS volume, count(*) AS n_ticks
  FROM bt GROUP BY ticker, date),
cal AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS step FROM (SELECT DISTINCT date FROM bbars)),
grid AS (SELECT t.ticker, c.date, c.step FROM (SELECT DISTINCT ticker FROM bbars) t CROSS JOIN cal c),
pz AS (SELECT g.ticker, g.date, g.step,
         coalesce(b.open, 0.0) AS open, coalesce(b.high, 0.0) AS high, coalesce(b.low, 0.0) AS low,
         coalesce(b.close, 0.0) AS close, coalesce(b.volume, 0.0) AS volume
       FROM grid g LEFT JOIN bbars b ON g.ticker = b.ticker AND g.date = b.date),
""" + "panel AS (SELECT ticker, date, step, " + ", ".join(
    f"""CASE WHEN {c} > 0 THEN {c} ELSE coalesce(
      (last_value(CASE WHEN {c} > 0 THEN {c} END IGNORE NULLS) OVER ({PX} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
     + first_value(CASE WHEN {c} > 0 THEN {c} END IGNORE NULLS) OVER ({PX} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) / 2,
      last_value(CASE WHEN {c} > 0 THEN {c} END IGNORE NULLS) OVER ({PX} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      first_value(CASE WHEN {c} > 0 THEN {c} END IGNORE NULLS) OVER ({PX} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
      100.0) END AS {c}""" for c in ("open", "high", "low", "close")) + """, volume FROM pz),
rel AS (SELECT ticker, step, least(greatest(CASE WHEN nxt IS NULL THEN 1.0 WHEN close > 1e-8 THEN nxt / close
                                      ELSE 1.0 END, 0.1), 10.0) AS rel
        FROM (SELECT ticker, step, close, lead(close) OVER (""" + PX + """) AS nxt FROM panel)),
prm AS (SELECT count(*) AS t, (SELECT count(DISTINCT ticker) FROM bbars) AS n, 30 AS first_step,
               CASE WHEN 30 < count(*) - 1 THEN count(*) - 2 ELSE 30 END AS last_step FROM cal),
acts AS (SELECT CAST(supplier AS VARCHAR) AS portfolio_id, c.step, ticker, sum(volume) AS raw
         FROM bt JOIN cal c ON bt.date = c.date GROUP BY 1, 2, 3),
wts AS (SELECT portfolio_id, step, ticker, greatest(raw, 0.0) / sum(greatest(raw, 0.0)) OVER (PARTITION BY portfolio_id, step) AS weight,
               sum(greatest(raw, 0.0)) OVER (PARTITION BY portfolio_id, step) AS tot
        FROM acts),
wpos AS (SELECT portfolio_id, step, ticker, weight FROM wts WHERE tot > 1e-8 AND weight > 0)"""

BT_TAIL = """
has AS (SELECT DISTINCT portfolio_id, step FROM wpos),
ports AS (SELECT DISTINCT portfolio_id FROM acts),
tick AS (SELECT DISTINCT ticker FROM bbars),
eff AS (SELECT p.portfolio_id, c.step, t.ticker,
          CASE WHEN h.portfolio_id IS NULL THEN 1.0 / prm.n ELSE coalesce(w.weight, 0.0) END AS w
        FROM ports p CROSS JOIN cal c CROSS JOIN tick t CROSS JOIN prm
        LEFT JOIN has h ON h.portfolio_id = p.portfolio_id AND h.step = c.step
        LEFT JOIN wpos w ON w.portfolio_id = p.portfolio_id AND w.step = c.step AND w.ticker = t.ticker
        WHERE c.step BETWEEN prm.first_step - 1 AND prm.last_step),
steps AS (SELECT e.portfolio_id, e.step,
            sum(CASE WHEN e.step = prm.first_step THEN 1.0 / prm.n ELSE o.w END * r.rel) AS market,
            sum(abs(e.w - CASE WHEN e.step = prm.first_step THEN 1.0 / prm.n ELSE o.w END)) AS turnover
          FROM eff e CROSS JOIN prm
          JOIN eff o ON o.portfolio_id = e.portfolio_id AND o.ticker = e.ticker AND o.step = e.step - 1
          JOIN rel r ON r.ticker = e.ticker AND r.step = e.step
          WHERE e.step BETWEEN prm.first_step AND prm.last_step
          GROUP BY e.portfolio_id, e.step),
growth AS (SELECT portfolio_id, step, turnover, market - 0.0005 * turnover AS growth FROM steps)"""

PATH = """
vp AS (SELECT *, greatest(10000.0 * product(growth) OVER (PARTITION BY portfolio_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1e-8) AS value
       FROM growth),
vq AS (SELECT *, growth - 1 AS ret,
          coalesce(lag(value) OVER (PARTITION BY portfolio_id ORDER BY step), 10000.0) * 0.0005 * turnover AS cost,
          CASE WHEN count(*) OVER (PARTITION BY portfolio_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 1
               THEN stddev_pop(growth - 1) OVER (PARTITION BY portfolio_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               ELSE 0.0 END AS volatility,
          greatest(max(value) OVER (PARTITION BY portfolio_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 10000.0) AS max_value,
          coalesce(max(CASE WHEN value <= 1000.0 THEN 1 ELSE 0 END) OVER (PARTITION BY portfolio_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended
       FROM vp),
res AS (SELECT portfolio_id, step + 1 AS step, value, ret, cost, volatility, max_value,
          (max_value - value) / max_value AS drawdown,
          least(greatest(100.0 * (ret - 0.0001 - cost / value - 0.1 * volatility - 0.5 * (max_value - value) / max_value), -5.0), 5.0) AS reward,
          turnover
        FROM vq WHERE ended = 0)"""

BT_COLS = ["portfolio_id", "step", "value", "ret", "cost", "volatility", "max_value", "drawdown",
           "reward", "turnover"]


def _bt(extra: str = "") -> str:
    return f"WITH {BRAND},{BT_TAIL},{PATH}{extra}"


def _bench() -> str:
    return f"""WITH {BRAND},
growth AS (SELECT 'equal_weight' AS portfolio_id, r.step, 0.0 AS turnover, avg(r.rel) AS growth
           FROM rel r CROSS JOIN prm WHERE r.step BETWEEN prm.first_step AND prm.last_step GROUP BY r.step),{PATH}"""


def q_brand_weekly_bars() -> str:
    return round_sql(f"WITH {BRAND} SELECT * FROM bbars", BAR_COLS, BAR_DBL, digits("brand_weekly_bars"))


def q_price_panel() -> str:
    cols = ["ticker", "date", "step", "open", "high", "low", "close", "volume"]
    return round_sql(f"WITH {BRAND} SELECT * FROM panel", cols, BAR_DBL, digits("price_panel"))


def q_price_relatives() -> str:
    return round_sql(f"WITH {BRAND} SELECT * FROM rel", ["ticker", "step", "rel"], {"rel"})


def q_portfolio_weights() -> str:
    return round_sql(f"WITH {BRAND} SELECT * FROM wpos", ["portfolio_id", "step", "ticker", "weight"],
                     {"weight"})


DBL_BT = set(BT_COLS) - {"portfolio_id", "step"}


def q_backtest() -> str:
    return round_sql(_bt(" SELECT * FROM res"), BT_COLS, DBL_BT, digits("backtest"))


def q_equal_weight_benchmark() -> str:
    return round_sql(_bench() + " SELECT * FROM res", BT_COLS, DBL_BT, digits("equal_weight_benchmark"))


CORE = """SELECT portfolio_id, count(*) AS n_steps, (arg_max(value, step) / 10000.0 - 1) * 100 AS total_return,
  (pow(1 + avg(ret), 252) - 1) * 100 AS annual_return, stddev_pop(ret) * sqrt(252) * 100 AS volatility,
  CASE WHEN stddev_pop(ret) * sqrt(252) * 100 > 0
       THEN ((pow(1 + avg(ret), 252) - 1) * 100) / (stddev_pop(ret) * sqrt(252) * 100) ELSE 0.0 END AS sharpe,
  max(drawdown) * 100 AS max_drawdown, avg(cost) AS avg_cost, sum(reward) AS total_reward,
  avg(reward) AS mean_reward, arg_max(value, step) AS final_value
FROM res GROUP BY portfolio_id"""
CORE_COLS = ["portfolio_id", "n_steps", "total_return", "annual_return", "volatility", "sharpe",
             "max_drawdown", "avg_cost", "total_reward", "mean_reward", "final_value"]


def q_performance_core() -> str:
    return round_sql(_bt(" " + CORE), CORE_COLS, set(CORE_COLS) - {"portfolio_id", "n_steps"},
                     digits("performance_core"))


DD = """,
dd0 AS (SELECT portfolio_id, step, ret,
          product(1 + ret) OVER (PARTITION BY portfolio_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wealth
        FROM res),
dd AS (SELECT portfolio_id, step, ret, wealth - 1 AS cumulative_return,
         CASE WHEN max(wealth) OVER (PARTITION BY portfolio_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 0 THEN NULL
              ELSE (wealth - max(wealth) OVER (PARTITION BY portfolio_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
                   / max(wealth) OVER (PARTITION BY portfolio_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS drawdown
       FROM dd0)"""


def q_drawdown_report() -> str:
    cols = ["portfolio_id", "step", "ret", "cumulative_return", "drawdown"]
    return round_sql(_bt(DD + " SELECT * FROM dd"), cols, {"ret", "cumulative_return", "drawdown"})


def q_performance_advanced() -> str:
    body = DD + """
SELECT portfolio_id,
  CASE WHEN count(CASE WHEN ret < 0 THEN ret END) > 0 AND stddev_pop(CASE WHEN ret < 0 THEN ret END) > 0
       THEN (pow(1 + avg(ret), 252) - 1 - 0.0) / (stddev_pop(CASE WHEN ret < 0 THEN ret END) * sqrt(252)) ELSE 0.0 END AS sortino,
  CASE WHEN min(drawdown) * 100 <> 0 THEN -(pow(1 + avg(ret), 252) - 1) / (min(drawdown) * 100 / 100) ELSE 0.0 END AS calmar,
  min(drawdown) * 100 AS max_drawdown_pct,
  CASE WHEN count(ret) > 2 THEN skewness(ret) END AS skewness,
  CASE WHEN count(ret) > 3 THEN kurtosis(ret) END AS kurtosis
FROM dd GROUP BY portfolio_id"""
    cols = ["portfolio_id", "sortino", "calmar", "max_drawdown_pct", "skewness", "kurtosis"]
    return round_sql(_bt(body), cols, set(cols) - {"portfolio_id"})


def q_benchmark_compare() -> str:
    bench_growth = """,
bg AS (SELECT r.step, avg(r.rel) AS growth FROM rel r CROSS JOIN prm
       WHERE r.step BETWEEN prm.first_step AND prm.last_step GROUP BY r.step),
bv AS (SELECT step, growth - 1 AS ret,
         greatest(10000.0 * product(growth) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1e-8) AS value
       FROM bg),
bv2 AS (SELECT *, coalesce(max(CASE WHEN value <= 1000.0 THEN 1 ELSE 0 END) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM bv),
bs AS (SELECT (arg_max(value, step) / 10000.0 - 1) * 100 AS bench_total_return,
              (pow(1 + avg(ret), 252) - 1) * 100 AS bench_annual_return,
              stddev_pop(ret) * sqrt(252) * 100 AS bench_volatility,
              arg_max(value, step) AS bench_final_value FROM bv2 WHERE ended = 0),
m AS (SELECT portfolio_id, (arg_max(value, step) / 10000.0 - 1) * 100 AS total_return,
             arg_max(value, step) AS final_value FROM res GROUP BY portfolio_id)
SELECT m.*, bs.*, CASE WHEN bench_volatility > 0 THEN bench_annual_return / bench_volatility ELSE 0.0 END AS bench_sharpe,
       total_return - bench_total_return AS outperformance,
       CASE WHEN bench_final_value = 0 THEN NULL ELSE final_value / bench_final_value END AS value_ratio
FROM m CROSS JOIN bs"""
    cols = ["portfolio_id", "total_return", "final_value", "bench_total_return", "bench_annual_return",
            "bench_volatility", "bench_final_value", "bench_sharpe", "outperformance", "value_ratio"]
    return round_sql(_bt(bench_growth), cols, set(cols) - {"portfolio_id"}, digits("benchmark_compare"))


def q_quick_eval() -> str:
    body = """,
h AS (SELECT *, row_number() OVER (PARTITION BY portfolio_id ORDER BY step) AS i FROM res)
SELECT portfolio_id, avg(reward) AS mean_reward,
  (arg_max(value, step) / arg_min(value, step) - 1) * 100 AS total_return,
  arg_max(value, step) AS final_value, stddev_pop(ret) * 100 AS volatility,
  avg(ret) / greatest(stddev_pop(ret), 1e-6) AS sharpe_ratio
FROM h WHERE i <= 100 GROUP BY portfolio_id"""
    cols = ["portfolio_id", "mean_reward", "total_return", "final_value", "volatility", "sharpe_ratio"]
    return round_sql(_bt(body), cols, set(cols) - {"portfolio_id"}, digits("quick_eval"))


def q_model_gate() -> str:
    body = f""",
core AS ({CORE})
SELECT portfolio_id, mean_reward, total_return, sharpe, max_drawdown / 100 AS max_drawdown,
  mean_reward > 0.1 AS reward_ok, total_return > 5.0 AS return_ok, sharpe > 0.5 AS sharpe_ok,
  max_drawdown / 100 < 0.2 AS drawdown_ok,
  CASE WHEN mean_reward > 0.1 AND total_return > 5.0 AND sharpe > 0.5 AND max_drawdown / 100 < 0.2
       THEN 'deploy' ELSE 'retrain' END AS decision
FROM core"""
    cols = ["portfolio_id", "mean_reward", "total_return", "sharpe", "max_drawdown", "reward_ok",
            "return_ok", "sharpe_ok", "drawdown_ok", "decision"]
    return round_sql(_bt(body), cols, {"mean_reward", "total_return", "sharpe", "max_drawdown"},
                     digits("model_gate"))


ORACLE = {
    "brand_weekly_bars": q_brand_weekly_bars,
    "price_panel": q_price_panel,
    "price_relatives": q_price_relatives,
    "portfolio_weights": q_portfolio_weights,
    "backtest": q_backtest,
    "equal_weight_benchmark": q_equal_weight_benchmark,
    "performance_core": q_performance_core,
    "drawdown_report": q_drawdown_report,
    "performance_advanced": q_performance_advanced,
    "benchmark_compare": q_benchmark_compare,
    "quick_eval": q_quick_eval,
    "model_gate": q_model_gate,
}


DRIFT = """
relo AS (SELECT ticker, step, CASE WHEN nxt IS NULL THEN 1.0 ELSE greatest(nxt, 1e-8) / greatest(open, 1e-8) END AS rel
         FROM (SELECT ticker, step, open, lead(open) OVER (PARTITION BY ticker ORDER BY step) AS nxt FROM panel)),
wz AS (SELECT portfolio_id, step, ticker, weight FROM wts WHERE tot > 0 AND weight > 0),
hz AS (SELECT DISTINCT portfolio_id, step FROM wz),
portz AS (SELECT DISTINCT portfolio_id FROM acts),
tickz AS (SELECT DISTINCT ticker FROM bbars),
ea AS (SELECT p.portfolio_id, c.step, t.ticker,
          CASE WHEN h.portfolio_id IS NULL THEN 1.0 / prm.n ELSE coalesce(w.weight, 0.0) END AS a
       FROM portz p CROSS JOIN cal c CROSS JOIN tickz t CROSS JOIN prm
       LEFT JOIN hz h ON h.portfolio_id = p.portfolio_id AND h.step = c.step
       LEFT JOIN wz w ON w.portfolio_id = p.portfolio_id AND w.step = c.step AND w.ticker = t.ticker
       WHERE c.step BETWEEN prm.first_step AND prm.last_step),
dr AS (SELECT e.portfolio_id, e.step + 1 AS step, e.ticker,
          e.a * r.rel / sum(e.a * r.rel) OVER (PARTITION BY e.portfolio_id, e.step) AS d
       FROM ea e JOIN relo r ON r.ticker = e.ticker AND r.step = e.step),
st AS (SELECT e.portfolio_id, e.step, sum(e.a * r.rel) AS market,
          least(sum(abs(e.a - CASE WHEN e.step = prm.first_step THEN 1.0 / prm.n ELSE d.d END)), 2.0) AS turnover
       FROM ea e CROSS JOIN prm JOIN relo r ON r.ticker = e.ticker AND r.step = e.step
       LEFT JOIN dr d ON d.portfolio_id = e.portfolio_id AND d.step = e.step AND d.ticker = e.ticker
       GROUP BY e.portfolio_id, e.step),
growth AS (SELECT portfolio_id, step, turnover, market - 0.0005 * turnover AS growth FROM st)"""

PATH_DRIFT = PATH.replace(
    "least(greatest(100.0 * (ret - 0.0001 - cost / value - 0.1 * volatility - 0.5 * (max_value - value) / max_value), -5.0), 5.0) AS reward",
    "least(greatest(ret * 100.0 - 0.5 * (max_value - value) / max_value, -5.0), 5.0) AS reward").replace(
    "CASE WHEN value <= 1000.0 THEN 1 ELSE 0 END", "CASE WHEN value < 5000.0 THEN 1 ELSE 0 END")


def q_backtest_open_drift() -> str:
    assert PATH_DRIFT != PATH
    return round_sql(f"WITH {BRAND},{DRIFT},{PATH_DRIFT} SELECT * FROM res", BT_COLS, DBL_BT,
                     digits("backtest"))


ORACLE["backtest_open_drift"] = q_backtest_open_drift
