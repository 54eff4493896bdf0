"""DuckDB oracle for describe / array statistics, report windows, the
feature tensor and the full feature stack."""

from __future__ import annotations

from functools import partial

from tickloom.plans.contracts import digits
from tickloom.plans.oracle import (BAR_COLS, BAR_DBL, BARS, TECH_COLS, bfill, div, price_inner, tech_inner,
                                   volume_inner)
from tickloom.plans.oracle_market import BRAND, _bt
from tickloom.plans.rounding import round_sql


def q_describe_bars():
    cols = ("open", "high", "low", "close", "volume", "n_ticks")
    unions = " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS value FROM bars""" for c in cols)
    inner = f"""WITH {BARS}, lg AS ({unions})
SELECT "column", count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
  quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75,
  max(value) AS max FROM lg GROUP BY 1"""
    out = ["column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    return round_sql(inner, out, set(out) - {"column", "count"}, digits("describe_bars"))


def q_array_stats_panel():
    cols = ("open", "high", "low", "close", "volume")
    unions = " UNION ALL ".join(f"SELECT CAST({c} AS DOUBLE) AS value FROM panel" for c in cols)
    inner = f"""WITH {BRAND}, lg AS ({unions})
SELECT CAST(count(*) / 5 AS BIGINT) AS n_rows, 5 AS n_cols, min(value) AS min, max(value) AS max,
  avg(value) AS mean, stddev_pop(value) AS std FROM lg"""
    return round_sql(inner, ["n_rows", "n_cols", "min", "max", "mean", "std"], {"min", "max", "mean", "std"},
                     digits("array_stats_panel"))


def q_rolling_report():
    body = """,
rr AS (SELECT portfolio_id, step, ret, count(*) OVER (PARTITION BY portfolio_id) AS n_total,
              row_number() OVER (PARTITION BY portfolio_id ORDER BY step) AS rn FROM res),
ww AS (SELECT *, least(252, CAST(floor(n_total / 2) AS INTEGER)) AS annual_window,
              least(30, CAST(floor(n_total / 4) AS INTEGER)) AS vol_window FROM rr),
agg AS (SELECT a.portfolio_id, a.step,
          avg(b.ret) FILTER (WHERE b.rn > a.rn - a.annual_window) AS ma,
          stddev_samp(b.ret) FILTER (WHERE b.rn > a.rn - a.vol_window) AS sv
        FROM ww a JOIN ww b ON a.portfolio_id = b.portfolio_id AND b.rn <= a.rn AND b.rn > a.rn - 252
        GROUP BY a.portfolio_id, a.step)
SELECT w.portfolio_id, w.step, w.ret, w.annual_window, w.vol_window,
  CASE WHEN w.n_total > w.annual_window AND w.annual_window > 0 AND w.rn >= w.annual_window THEN g.ma * 252 * 100 END
    AS rolling_annual_return,
  CASE WHEN w.vol_window > 1 AND w.rn >= w.vol_window THEN g.sv * sqrt(252) * 100 END AS rolling_volatility
FROM ww w JOIN agg g ON w.portfolio_id = g.portfolio_id AND w.step = g.step"""
    cols = ["portfolio_id", "step", "ret", "annual_window", "vol_window", "rolling_annual_return",
            "rolling_volatility"]
    return round_sql(_bt(body), cols, {"ret", "rolling_annual_return", "rolling_volatility"},
                     digits("rolling_report"))


def q_return_histogram():
    body = """,
mm AS (SELECT min(ret * 100) AS lo, max(ret * 100) AS hi FROM res),
wd AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0 END AS width FROM mm),
b AS (SELECT least(CAST(floor((r.ret * 100 - wd.lo) / wd.width) AS INTEGER), 49) AS bin, wd.lo, wd.width
      FROM res r CROSS JOIN wd WHERE r.ret IS NOT NULL)
SELECT bin, lo + bin * width AS lower, lo + (bin + 1) * width AS upper, count(*) AS count
FROM b GROUP BY bin, lo, width"""
    return round_sql(_bt(body), ["bin", "lower", "upper", "count"], {"lower", "upper"})


TENSOR = ("Open", "High", "Low", "Close", "Volume", "SMA", "EMA", "RSI", "BB_Width", "Volatility",
          "Volume_Change", "Daily_Return")
SRC = {"Open": "open", "High": "high", "Low": "low", "Close": "close", "Volume": "volume",
       "Daily_Return": "Returns"}


def q_feature_tensor():
    prefix = BRAND + ",\nbars AS (SELECT ticker, date, open, high, low, close, volume, n_ticks FROM bbars)"
    unions = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, ticker, date, CAST(\"{SRC.get(n, n)}\" AS DOUBLE) AS value FROM k" for n in TENSOR)
    inner = f"""WITH f AS ({tech_inner(prefix)}),
cd AS (SELECT date FROM f GROUP BY date HAVING count(DISTINCT ticker) = (SELECT count(DISTINCT ticker) FROM f)),
top AS (SELECT date FROM cd ORDER BY date DESC LIMIT 30),
k AS (SELECT * FROM f WHERE date IN (SELECT date FROM top))
{unions}"""
    return round_sql(inner, ["feature", "ticker", "date", "value"], {"value"}, digits("feature_tensor"))


CORR_COLS = ["Corr_1_10d", "Corr_1_20d", "Corr_1_60d"]


def corr_inner():
    """Correlations with the smallest other supplier of the nation, on common dates."""
    def fr(n):
        return f"OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    cs = [f"CASE WHEN count(xb) {fr(n)} = {n} THEN "
          f"{div(f'covar_samp(xb, yb) {fr(n)}', f'stddev_samp(xb) {fr(n)} * stddev_samp(yb) {fr(n)}')} END AS {c}"
          for n, c in zip((10, 20, 60), CORR_COLS)]
    return f"""WITH {BARS},
sp AS (SELECT CAST(s_suppkey AS VARCHAR) AS ticker, CAST((SELECT min(o.s_suppkey) FROM supplier o
         WHERE o.s_nationkey = s.s_nationkey AND o.s_suppkey <> s.s_suppkey) AS VARCHAR) AS other FROM supplier s),
pr AS (SELECT sp.ticker, a.date, CASE WHEN b.close IS NOT NULL THEN a.close END AS xb, CASE WHEN a.close IS NOT NULL THEN b.close END AS yb
       FROM sp JOIN bars a ON a.ticker = sp.ticker JOIN bars b ON b.ticker = sp.other AND b.date = a.date),
cc AS (SELECT ticker, date, {', '.join(cs)} FROM pr),
al AS (SELECT bars.ticker, bars.date, {', '.join(CORR_COLS)} FROM bars LEFT JOIN cc ON bars.ticker = cc.ticker AND bars.date = cc.date)
SELECT ticker, date, {', '.join(f'{bfill(c)} AS {c}' for c in CORR_COLS)} FROM al"""


def q_feature_stack():
    p_inner, p_new = price_inner()
    v_inner, v_new = volume_inner()
    t_cols = [c for c in TECH_COLS if c != "Volume_Change"]
    sel = (["t." + c for c in BAR_COLS] + [f't."{c}"' for c in t_cols] + [f'p."{c}"' for c in p_new]
           + [f'v."{c}"' for c in v_new] + [f"c.{c}" for c in CORR_COLS])
    inner = f"""SELECT {', '.join(sel)} FROM ({tech_inner()}) t
JOIN ({corr_inner()}) c ON t.ticker = c.ticker AND t.date = c.date
JOIN ({p_inner}) p ON t.ticker = p.ticker AND t.date = p.date
JOIN ({v_inner}) v ON t.ticker = v.ticker AND t.date = v.date"""
    cols = BAR_COLS + t_cols + p_new + v_new + CORR_COLS
    return round_sql(inner, cols, BAR_DBL | set(t_cols) | set(p_new) | set(v_new) | set(CORR_COLS), digits("feature_stack"))


ORACLE = {
    "describe_bars": q_describe_bars,
    "array_stats_panel": q_array_stats_panel,
    "rolling_report": q_rolling_report,
    "return_histogram": q_return_histogram,
    "feature_tensor": q_feature_tensor,
    "feature_stack": q_feature_stack,
}


def q_observation_windows():
    inner = f"""WITH {BRAND},
lagk AS (SELECT CAST(range AS INTEGER) AS lag FROM range(1, 11)),
lp AS ({' UNION ALL '.join(f"SELECT ticker, step, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM panel" for c in ("open", "high", "low", "close", "volume"))}),
o AS (SELECT p.ticker, p.step, p.feature, k.lag, coalesce(q.x, 0.0) AS x
      FROM lp p CROSS JOIN lagk k
      LEFT JOIN lp q ON q.ticker = p.ticker AND q.feature = p.feature AND q.step = p.step - 10 + k.lag - 1),
s AS (SELECT *, avg(x) OVER (PARTITION BY ticker, step, feature) AS m, stddev_pop(x) OVER (PARTITION BY ticker, step, feature) AS sd FROM o)
SELECT ticker, step, feature, lag, CASE WHEN sd > 1e-8 THEN (x - m) / sd ELSE 0.0 END AS value FROM s"""
    return round_sql(inner, ["ticker", "step", "feature", "lag", "value"], {"value"})


def q_risk_ratios():
    from tickloom.plans.oracle_market import CORE
    body = f""",
core AS ({CORE})
SELECT portfolio_id,
  CASE WHEN volatility / 100 = 0 THEN NULL ELSE (annual_return / 100 - 0.02) / (volatility / 100) END AS sharpe_rf,
  CASE WHEN max_drawdown / 100 = 0 THEN NULL ELSE (annual_return / 100) / (max_drawdown / 100) END AS calmar_ratio
FROM core"""
    return round_sql(_bt(body), ["portfolio_id", "sharpe_rf", "calmar_ratio"], {"sharpe_rf", "calmar_ratio"})


# Substrings that select each feature category.
CATEGORY_NAMES = {
    "price": ("Open", "High", "Low", "Close", "Return", "MA", "Price"),
    "volume": ("Volume", "OBV", "CMF"),
    "technical": ("SMA", "EMA", "MACD", "RSI", "Stoch", "BB", "Volatility"),
}


def q_category(category):
    p_inner, p_new = price_inner()
    v_inner, v_new = volume_inner()
    t_cols = [c for c in TECH_COLS if c != "Volume_Change"]
    allc = t_cols + p_new + v_new
    pick = [c for c in allc if any(p in c for p in CATEGORY_NAMES[category])]
    src = {c: "t" for c in t_cols} | {c: "p" for c in p_new} | {c: "v" for c in v_new}
    sel = ["t.ticker", "t.date"] + [f'{src[c]}."{c}"' for c in pick]
    inner = f"""SELECT {', '.join(sel)} FROM ({tech_inner()}) t
JOIN ({p_inner}) p ON t.ticker = p.ticker AND t.date = p.date
JOIN ({v_inner}) v ON t.ticker = v.ticker AND t.date = v.date"""
    return round_sql(inner, ["ticker", "date"] + pick, set(pick), digits(f"{category}_category"))


def q_feature_set_members():
    inner = f"""WITH {BRAND},
st AS (SELECT * FROM (VALUES ('technical', '14'), ('price', '20'), ('volume', '20'), ('correlation', '60')) t(category, w)),
c AS (SELECT b.ticker, st.category, b.ticker || '_' || st.category AS name, 'v1' AS version, st.w
      FROM (SELECT DISTINCT ticker FROM bbars) b CROSS JOIN st)
SELECT md5(name || '_' || version || '_' || '{{"window": ' || w || '}}') AS id, ticker AS set_name, ticker,
       category, name, version FROM c"""
    return round_sql(inner, ["id", "set_name", "ticker", "category", "name", "version"], set())


ORACLE.update({
    "observation_windows": q_observation_windows,
    "risk_ratios": q_risk_ratios,
    **{f"{c}_category": partial(q_category, c) for c in CATEGORY_NAMES},
    "feature_set_members": q_feature_set_members,
})
