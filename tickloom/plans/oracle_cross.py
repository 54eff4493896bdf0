"""DuckDB oracle for the cross-asset queries (as-of join, pair and market
correlations); the as-of alignment uses DuckDB's native ASOF JOIN."""

from __future__ import annotations

from tickloom.plans.contracts import digits
from tickloom.plans.oracle import BAR_COLS, BAR_DBL, div, full
from tickloom.plans.oracle_market import BRAND
from tickloom.plans.rounding import round_sql

MKT = """mkt AS (SELECT CAST(l_shipdate AS DATE) AS date, sum(l_extendedprice) / sum(l_quantity) AS close
        FROM lineitem GROUP BY 1),
al AS (SELECT b.*, m.close AS m_close FROM bbars b ASOF LEFT JOIN mkt m ON b.date >= m.date)"""


def q_asof_market() -> str:
    return round_sql(f"WITH {BRAND}, {MKT} SELECT * FROM al", BAR_COLS + ["m_close"],
                     BAR_DBL | {"m_close"}, digits("asof_market"))


PW = "PARTITION BY ticker, other ORDER BY date"


def q_pair_correlations() -> str:
    def fr(n):
        return f"OVER ({PW} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    cs = []
    for n in (10, 20, 60):
        cs.append(f"CASE WHEN count(xb) {fr(n)} = {n} THEN "
                  f"{div(f'covar_samp(xb, yb) {fr(n)}', f'stddev_samp(xb) {fr(n)} * stddev_samp(yb) {fr(n)}')}"
                  f" END AS c{n}")
    bf = ", ".join(f"first_value(c{n} IGNORE NULLS) OVER ({PW} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS Corr_{n}d"
                   for n in (10, 20, 60))
    inner = f"""WITH {BRAND},
pg AS (SELECT g.ticker, g.date, b.close FROM grid g LEFT JOIN bbars b ON g.ticker = b.ticker AND g.date = b.date),
pr AS (SELECT a.ticker, b.ticker AS other, a.date,
              CASE WHEN a.close IS NOT NULL AND b.close IS NOT NULL THEN a.close END AS xb,
              CASE WHEN a.close IS NOT NULL AND b.close IS NOT NULL THEN b.close END AS yb
       FROM pg a JOIN pg b ON a.date = b.date AND a.ticker < b.ticker),
cc AS (SELECT ticker, other, date, {', '.join(cs)} FROM pr),
half AS (SELECT ticker, other, date, {bf} FROM cc)
SELECT * FROM half UNION ALL SELECT other AS ticker, ticker AS other, date, Corr_10d, Corr_20d, Corr_60d FROM half"""
    cols = ["ticker", "other", "date", "Corr_10d", "Corr_20d", "Corr_60d"]
    return round_sql(inner, cols, {"Corr_10d", "Corr_20d", "Corr_60d"})


def q_market_features() -> str:
    W = "PARTITION BY ticker ORDER BY date"

    def fr(n):
        return f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    rf = repr(0.01 / 252)
    feats, names = [], []
    for n in (5, 10, 20, 60):
        cov = f"CASE WHEN count(rsb) {fr(n)} = {n} THEN covar_samp(rsb, rmb) {fr(n)} END"
        var = full("var_samp", "rm", n)
        beta = div(cov, var)
        feats += [f"{beta} AS b{n}",
                  f"({full('avg', 'rs', n)}) - {rf} - {beta} * (({full('avg', 'rm', n)}) - {rf}) AS a{n}",
                  f"CASE WHEN count(rsb) {fr(n)} = {n} THEN {div(f'covar_samp(rsb, rmb) {fr(n)}', f'stddev_samp(rsb) {fr(n)} * stddev_samp(rmb) {fr(n)}')} END AS mc{n}",
                  f"{div(div('close', f'lag(close, {n}) OVER ({W})'), div('m_close', f'lag(m_close, {n}) OVER ({W})'))} AS rl{n}"]
        names += [(f"b{n}", f"Beta_{n}d"), (f"a{n}", f"Alpha_{n}d"), (f"mc{n}", f"Market_Corr_{n}d"),
                  (f"rl{n}", f"Rel_Strength_{n}d")]
    bf = ", ".join(f"first_value({a} IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {b}"
                   for a, b in names)
    inner = f"""WITH {BRAND}, {MKT},
r0 AS (SELECT *, {div('close', f'lag(close) OVER ({W})')} - 1 AS rs,
              {div('m_close', f'lag(m_close) OVER ({W})')} - 1 AS rm FROM al),
r1 AS (SELECT *, CASE WHEN rs IS NOT NULL AND rm IS NOT NULL THEN rs END AS rsb,
              CASE WHEN rs IS NOT NULL AND rm IS NOT NULL THEN rm END AS rmb FROM r0),
r2 AS (SELECT {', '.join(BAR_COLS)}, m_close, {', '.join(feats)} FROM r1)
SELECT {', '.join(BAR_COLS)}, m_close, {bf} FROM r2"""
    cols = BAR_COLS + ["m_close"] + [b for _, b in names]
    return round_sql(inner, cols, BAR_DBL | {"m_close"} | {b for _, b in names}, digits("market_features"))


ORACLE = {
    "asof_market": q_asof_market,
    "pair_correlations": q_pair_correlations,
    "market_features": q_market_features,
}
