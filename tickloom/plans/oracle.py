"""Independent DuckDB SQL for every registered query that SQL can express.

Written directly against the raw tables (lineitem, part, events, orders);
it shares no code path with the Spark operators, only the output contract
(column names and rounding digits).  Recurrences (EMA, RSI) use their closed
form  y_t = q^t·x_0 + α·Σ_{j≤t} q^{t−j}·x_j,  q = 1−α.
"""

from __future__ import annotations

from tickloom.plans.contracts import BAR_DIG, WINDOWS, digits
from tickloom.plans.rounding import round_sql

W = "PARTITION BY ticker ORDER BY date"


def over(frame: str = "", part: str = W) -> str:
    return f"OVER ({part}{' ' + frame if frame else ''})"


def trail(n: int) -> str:
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
AHEAD = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"


def full(agg: str, x: str, n: int, part: str = W) -> str:
    return (f"CASE WHEN count({x}) {over(trail(n), part)} = {n} "
            f"THEN {agg}({x}) {over(trail(n), part)} END")


def div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"


def bfill(x: str, part: str = W) -> str:
    return f"first_value({x} IGNORE NULLS) {over(AHEAD, part)}"


def ordkey(*cols: str) -> str:
    return "struct_pack(" + ", ".join(f"{c} := {c}" for c in cols) + ")"


TICKS = """ticks AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker, l_shipdate AS ts, CAST(l_shipdate AS DATE) AS date,
         CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS price,
         CAST(l_quantity AS DOUBLE) AS volume, l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3
  FROM lineitem)"""

BARS = TICKS + f""",
bars AS (
  SELECT ticker, date,
    arg_min(price, {ordkey('ts', 'k1', 'k2', 'k3')}) FILTER (WHERE price IS NOT NULL) AS open,
    max(price) AS high, min(price) AS low,
    arg_max(price, {ordkey('ts', 'k1', 'k2', 'k3')}) FILTER (WHERE price IS NOT NULL) AS close,
    sum(volume) AS volume, count(*) AS n_ticks
  FROM ticks GROUP BY ticker, date)"""

BAR_COLS = ["ticker", "date", "open", "high", "low", "close", "volume", "n_ticks"]
BAR_DBL = {"open", "high", "low", "close", "volume"}


def _ema(x: str, alpha: float, start: int = 0, x0: str | None = None) -> str:
    """EMA (adjust=False) seeded at row ``start`` with value ``x0``."""
    q = 1.0 - alpha
    x0 = x0 or f"first_value({x}) {over()}"
    s = (f"sum(CASE WHEN rn > {start} THEN {x} * pow({q!r}, -(rn - {start})) ELSE 0 END) "
         f"{over(RUN)}")
    return f"pow({q!r}, rn - {start}) * ({x0} + {alpha!r} * {s})"


def q_daily_bars() -> str:
    return round_sql(f"WITH {BARS} SELECT * FROM bars", BAR_COLS, BAR_DBL, digits("daily_bars"))


def q_ticker_summary() -> str:
    inner = f"""WITH {BARS},
f AS (SELECT ticker, date, close, {div('close', f'lag(close) {over()}')} - 1 AS ret,
        {full('avg', 'close', 20)} AS ma, {full('stddev_samp', 'close', 20)} AS sd FROM bars)
SELECT ticker, count(*) AS n_bars, avg(close) AS mean_close, avg(ret) * 100 AS mean_return_pct,
       stddev_samp(ret) * 100 AS std_return_pct, arg_max(ma, date) AS last_ma_20,
       arg_max(sd, date) AS last_std_20
FROM f GROUP BY ticker"""
    cols = ["ticker", "n_bars", "mean_close", "mean_return_pct", "std_return_pct", "last_ma_20",
            "last_std_20"]
    return round_sql(inner, cols, set(cols) - {"ticker", "n_bars"}, digits("ticker_summary"))


TECH_COLS = ["SMA", "EMA", "MACD", "MACD_Signal", "MACD_Diff", "RSI", "Stoch", "Stoch_Signal",
             "BB_High", "BB_Low", "BB_Width", "Returns", "Volatility", "Volume_SMA", "Volume_Change"]


def tech_inner(prefix: str = BARS) -> str:
    """Technical stage over a ``bars`` CTE defined by ``prefix``."""
    bc = ", ".join(BAR_COLS)
    return f"""WITH {prefix},
t0 AS (SELECT *, row_number() {over()} - 1 AS rn, lag(close) {over()} AS prev_c,
              lag(volume) {over()} AS prev_v FROM bars),
t1 AS (SELECT *, CASE WHEN rn = 0 THEN 0.0 ELSE greatest(close - prev_c, 0.0) END AS up,
              CASE WHEN rn = 0 THEN 0.0 ELSE greatest(prev_c - close, 0.0) END AS dn FROM t0),
t2 AS (SELECT *, {_ema('close', 2 / 15)} AS e14, {_ema('close', 2 / 13)} AS e12,
              {_ema('close', 2 / 27)} AS e26, {_ema('up', 1 / 14)} AS eu, {_ema('dn', 1 / 14)} AS ed
       FROM t1),
t3 AS (SELECT *, CASE WHEN rn >= 25 THEN e12 - e26 END AS macd FROM t2),
t4 AS (SELECT *, {_ema('macd', 0.2, 25, f"first_value(macd IGNORE NULLS) {over('ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING')}")} AS sig_raw
       FROM t3),
t5 AS (SELECT {bc}, rn, close AS c_,
    {full('avg', 'close', 14)} AS SMA,
    CASE WHEN rn >= 13 THEN e14 END AS EMA,
    macd AS MACD,
    CASE WHEN rn >= 33 THEN sig_raw END AS MACD_Signal,
    CASE WHEN rn < 13 THEN NULL WHEN ed = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + eu / ed) END AS RSI,
    100 * {div(f"close - ({full('min', 'low', 14)})", f"({full('max', 'high', 14)}) - ({full('min', 'low', 14)})")} AS Stoch,
    {full('stddev_pop', 'close', 14)} AS sd14,
    {div('close', 'prev_c')} - 1 AS Returns,
    {full('avg', 'volume', 14)} AS Volume_SMA,
    {div('volume', 'prev_v')} - 1 AS Volume_Change
  FROM t4),
t6 AS (SELECT *, MACD - MACD_Signal AS MACD_Diff, SMA + 2 * sd14 AS BB_High, SMA - 2 * sd14 AS BB_Low,
    {full('avg', 'Stoch', 3)} AS Stoch_Signal,
    {full('stddev_samp', 'Returns', 30)} * sqrt(252) AS Volatility
  FROM t5),
t7 AS (SELECT *, {div('BB_High - BB_Low', 'close')} AS BB_Width FROM t6)
SELECT {bc}, {', '.join(f'{bfill(c)} AS "{c}"' for c in TECH_COLS)} FROM t7"""


def q_technical_indicators() -> str:
    inner = tech_inner()
    cols = BAR_COLS + TECH_COLS
    return round_sql(inner, cols, BAR_DBL | set(TECH_COLS), digits("technical_indicators"))


def price_inner() -> tuple[str, list[str]]:
    bc = ", ".join(BAR_COLS)
    per = []
    for n in WINDOWS:
        per += [f"{div('close', f'lag(close, {n}) {over()}')} - 1 AS Return_{n}d",
                f"{full('avg', 'close', n)} AS MA_{n}d",
                f"{full('stddev_samp', 'close', n)} AS Std_{n}d",
                f"{full('max', 'close', n)} AS Max_{n}d",
                f"{full('min', 'close', n)} AS Min_{n}d"]
    per2 = []
    for n in WINDOWS:
        per2 += [f"{div('close', f'MA_{n}d')} AS Price_to_MA_{n}d",
                 f"{div(f'close - MA_{n}d', f'MA_{n}d')} * 100 AS Price_MA_{n}d_Gap",
                 f"{full('avg', 'True_Range', n)} AS ATR_{n}d"]
    new = ["Daily_Return"]
    for n in WINDOWS:
        new += [f"Return_{n}d", f"MA_{n}d", f"Std_{n}d", f"Max_{n}d", f"Min_{n}d"]
    new += ["High_Low", "High_PrevClose", "Low_PrevClose", "True_Range"]
    for n in WINDOWS:
        new += [f"Price_to_MA_{n}d", f"Price_MA_{n}d_Gap", f"ATR_{n}d"]
    inner = f"""WITH {BARS},
p0 AS (SELECT *, lag(close) {over()} AS prev_c FROM bars),
p1 AS (SELECT *, {div('close', 'prev_c')} - 1 AS Daily_Return, {', '.join(per)},
         high - low AS High_Low, abs(high - prev_c) AS High_PrevClose, abs(low - prev_c) AS Low_PrevClose
       FROM p0),
p2 AS (SELECT *, greatest(High_Low, High_PrevClose, Low_PrevClose) AS True_Range FROM p1),
p3 AS (SELECT *, {', '.join(per2)} FROM p2)
SELECT {bc}, {', '.join(f'{bfill(c)} AS "{c}"' for c in new)} FROM p3"""
    return inner, new


def q_price_features() -> str:
    inner, new = price_inner()
    return round_sql(inner, BAR_COLS + new, BAR_DBL | set(new), digits("price_features"))


def volume_inner() -> tuple[str, list[str]]:
    bc = ", ".join(BAR_COLS)
    mf = f"{div('(close - low) - (high - close)', 'high - low')} * volume"
    new = ["Volume_Change"] + [f"Volume_MA_{n}d" for n in WINDOWS] + ["OBV"] + \
          [f"CMF_{n}d" for n in WINDOWS] + [f"Volume_Ratio_{n}d" for n in WINDOWS]
    inner = f"""WITH {BARS},
v0 AS (SELECT *, lag(close) {over()} AS prev_c, lag(volume) {over()} AS prev_v, {mf} AS mf FROM bars),
v1 AS (SELECT *, {div('volume', 'prev_v')} - 1 AS Volume_Change,
    {', '.join(f"{full('avg', 'volume', n)} AS Volume_MA_{n}d" for n in WINDOWS)},
    sum(coalesce(sign(close - prev_c) * volume, 0.0)) {over(RUN)} AS OBV,
    {', '.join(f"{div(full('sum', 'mf', n), full('sum', 'volume', n))} AS CMF_{n}d" for n in WINDOWS)}
  FROM v0),
v2 AS (SELECT *, {', '.join(f"{div('volume', f'Volume_MA_{n}d')} AS Volume_Ratio_{n}d" for n in WINDOWS)} FROM v1)
SELECT {bc}, {', '.join(f'{bfill(c)} AS "{c}"' for c in new)} FROM v2"""
    return inner, new


def q_volume_features() -> str:
    inner, new = volume_inner()
    return round_sql(inner, BAR_COLS + new, BAR_DBL | set(new), digits("volume_features"))


ORACLE = {
    "daily_bars": q_daily_bars,
    "ticker_summary": q_ticker_summary,
    "technical_indicators": q_technical_indicators,
    "price_features": q_price_features,
    "volume_features": q_volume_features,
}


def oracle_sql() -> dict[str, str]:
    from tickloom.plans import (oracle_clean, oracle_cross, oracle_features, oracle_market, oracle_monitoring,
                                oracle_operations, oracle_ops, oracle_reports, oracle_scoring,
                                oracle_states)
    allq = {**ORACLE, **oracle_market.ORACLE, **oracle_clean.ORACLE, **oracle_cross.ORACLE,
            **oracle_monitoring.ORACLE, **oracle_ops.ORACLE, **oracle_scoring.ORACLE,
            **oracle_reports.ORACLE, **oracle_operations.ORACLE, **oracle_features.ORACLE,
            **oracle_states.ORACLE}
    return {k: f() for k, f in allq.items()}
