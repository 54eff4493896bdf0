"""DuckDB oracle for the feature-store, as-of, tick-grain, fitted and model queries."""

from __future__ import annotations

import hashlib
import json

from tickloom.plans.oracle import BARS, div, full, over
from tickloom.plans.oracle_market import BRAND
from tickloom.plans.rounding import round_sql

EV = """ev AS (SELECT event_id, date_trunc('second', ts) AS ts, event_type, value,
  CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS account FROM events)"""


def q_asof_events():
    inner = f"""WITH {EV},
p AS (SELECT ts, max(event_id) AS purchase_id, arg_max(value, event_id) AS purchase_value FROM ev
      WHERE event_type = 'purchase' GROUP BY ts)
SELECT event_id, event_type, value, purchase_id, purchase_value FROM ev ASOF LEFT JOIN p ON ev.ts >= p.ts"""
    return round_sql(inner, ["event_id", "event_type", "value", "purchase_id", "purchase_value"], {"value", "purchase_value"})


def q_asof_account_events():
    inner = f"""WITH {EV},
p AS (SELECT account, ts, max(event_id) AS purchase_id, arg_max(value, event_id) AS purchase_value FROM ev
      WHERE event_type = 'purchase' GROUP BY account, ts)
SELECT event_id, ev.account, event_type, value, purchase_id, purchase_value
FROM ev ASOF LEFT JOIN p ON ev.account = p.account AND ev.ts >= p.ts"""
    return round_sql(inner, ["event_id", "account", "event_type", "value", "purchase_id", "purchase_value"],
                     {"value", "purchase_value"})


def q_tick_indicators():
    """The recurrences row by row."""
    inner = """WITH RECURSIVE x AS (
  SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 'system' ELSE event_type END AS ticker, value AS c,
    row_number() OVER w - 1 AS rn, value - lag(value) OVER w AS d FROM events WHERE value IS NOT NULL
  WINDOW w AS (PARTITION BY CASE WHEN event_type IN ('error', 'signup') THEN 'system' ELSE event_type END ORDER BY ts, event_id)),
r AS (
  SELECT event_id, ticker, rn, c AS e, c AS f, c AS s, NULL::DOUBLE AS g, 0.0::DOUBLE AS u, 0.0::DOUBLE AS dn FROM x WHERE rn = 0
  UNION ALL
  SELECT y.event_id, y.ticker, y.rn, e + (y.c - e) * 2 / 15, f + (y.c - f) * 2 / 13, s + (y.c - s) * 2 / 27,
    CASE WHEN y.rn < 25 THEN NULL WHEN y.rn = 25 THEN (f + (y.c - f) * 2 / 13) - (s + (y.c - s) * 2 / 27)
         ELSE g + ((f + (y.c - f) * 2 / 13) - (s + (y.c - s) * 2 / 27) - g) * 0.2 END,
    u + (greatest(y.d, 0.0) - u) / 14, dn + (greatest(-y.d, 0.0) - dn) / 14
  FROM r JOIN x y ON y.ticker = r.ticker AND y.rn = r.rn + 1)
SELECT event_id, ticker, CASE WHEN rn >= 13 THEN e END AS "EMA", CASE WHEN rn >= 25 THEN f - s END AS "MACD",
  CASE WHEN rn >= 33 THEN g END AS "MACD_Signal", CASE WHEN rn >= 33 THEN f - s - g END AS "MACD_Diff",
  CASE WHEN rn < 13 THEN NULL WHEN dn = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + u / dn) END AS "RSI" FROM r
UNION ALL
SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 'system' ELSE event_type END, NULL, NULL, NULL, NULL, NULL
FROM events WHERE value IS NULL"""
    cols = ["EMA", "MACD", "MACD_Signal", "MACD_Diff", "RSI"]
    return round_sql(inner, ["event_id", "ticker", *cols], set(cols))


FEATURES = f"""{BRAND},
fr AS (SELECT ticker, date, close, {div('close', f'lag(close) {over()}')} - 1 AS Daily_Return,
  {full('avg', 'close', 5)} AS MA_5d, {full('stddev_samp', 'close', 5)} AS Std_5d FROM bbars),
fv AS (SELECT ticker, date, {div('volume', f'lag(volume) {over()}')} - 1 AS Volume_Change,
  {full('avg', 'volume', 5)} AS Volume_MA_5d FROM bbars)"""


def q_feature_store_round_trip():
    return round_sql(f"WITH {FEATURES} SELECT *, 2 AS commits FROM fr",
                     ["ticker", "date", "close", "Daily_Return", "MA_5d", "Std_5d", "commits"],
                     {"close", "Daily_Return", "MA_5d", "Std_5d"})


def q_feature_set_data():
    inner = f"WITH {FEATURES} SELECT * FROM fr FULL JOIN fv USING (ticker, date)"
    doubles = ["close", "Daily_Return", "MA_5d", "Std_5d", "Volume_Change", "Volume_MA_5d"]
    return round_sql(inner, ["ticker", "date", *doubles], set(doubles))


def q_feature_listing():
    def row(name, parameters, n_columns, column, cte):
        ident = hashlib.md5(f"{name}_latest_{json.dumps(parameters, sort_keys=True)}".encode()).hexdigest()
        return f"""SELECT '{ident}' AS id, '{name}' AS name, 'latest' AS version, '5' AS "window", count(*) AS n_rows,
  {n_columns} AS n_columns, avg({column}) AS mean_of_first, stddev_samp({column}) AS std_of_first, 1::BIGINT AS "commit" FROM {cte}"""
    inner = f"""WITH {FEATURES}
{row("returns", {"window": 5}, 6, "close", "fr")}
UNION ALL {row("volumes", {"window": 5, "kind": "weekly"}, 4, "Volume_MA_5d", "fv")}"""
    return round_sql(inner, ["id", "name", "version", "window", "n_rows", "n_columns", "mean_of_first", "std_of_first", "commit"],
                     {"mean_of_first", "std_of_first"})


def q_normalized_split():
    prices = ("open", "high", "low", "close")
    refs = ", ".join(f"arg_min({c}, date) FILTER (WHERE {c} > 0) AS r_{c}" for c in prices)
    scaled = ", ".join(f"CASE WHEN r_{c} IS NULL THEN 1.0 ELSE {c} / r_{c} END AS {c}" for c in prices)
    inner = f"""WITH {BARS},
cal AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS period, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM bars)),
sp AS (SELECT b.*, CASE WHEN period < greatest(10, least(CAST(floor(n * 0.7) AS BIGINT), n - 10)) THEN 'train' ELSE 'test' END AS split
       FROM bars b JOIN cal USING (date)),
fit AS (SELECT ticker, {refs}, max(volume) AS top FROM sp WHERE split = 'train' GROUP BY ticker)
SELECT sp.ticker, date, split, {scaled}, CASE WHEN top > 0 THEN volume / top ELSE 0.1 END AS volume
FROM sp LEFT JOIN fit ON sp.ticker = fit.ticker"""
    return round_sql(inner, ["ticker", "date", "split", *prices, "volume"], {*prices, "volume"})


def q_model_scores():
    inner = f"""WITH {BRAND},
lagk AS (SELECT CAST(range AS INTEGER) AS lag FROM range(1, 11)),
lp AS (SELECT ticker, step, 1 AS w, close AS x FROM panel UNION ALL SELECT ticker, step, 2, CAST(volume AS DOUBLE) FROM panel),
o AS (SELECT p.ticker, p.step, p.w, k.lag, coalesce(q.x, 0.0) AS x FROM lp p CROSS JOIN lagk k
      LEFT JOIN lp q ON q.ticker = p.ticker AND q.w = p.w AND q.step = p.step - 10 + k.lag - 1),
s AS (SELECT *, avg(x) OVER (PARTITION BY ticker, step, w) AS m, stddev_pop(x) OVER (PARTITION BY ticker, step, w) AS sd FROM o)
SELECT ticker, step, sum(CASE WHEN sd > 1e-8 THEN (x - m) / sd ELSE 0.0 END * w * lag / 10.0) AS score FROM s GROUP BY ticker, step"""
    return round_sql(inner, ["ticker", "step", "score"], {"score"})


CURRENT = """cw AS (SELECT w.portfolio_id, w.ticker, w.weight FROM wpos w
  JOIN (SELECT portfolio_id, max(step) AS step FROM wpos GROUP BY portfolio_id) n ON w.portfolio_id = n.portfolio_id AND w.step = n.step)"""


def q_allocation_features():
    features = ("open", "high", "low", "close", "volume")
    stats = ", ".join(f"avg({f}) AS {f}_mean, stddev_pop({f}) AS {f}_std, arg_max(CAST({f} AS DOUBLE), step) AS {f}_last" for f in features)
    names = [f"{f}_{s}" for f in features for s in ("mean", "std", "last")]
    inner = f"""WITH {BRAND}, {CURRENT},
st AS (SELECT ticker, {stats} FROM panel WHERE step > (SELECT max(step) - 30 FROM cal) GROUP BY ticker)
SELECT cw.portfolio_id, cw.ticker, cw.weight AS current_weight, {', '.join(names)} FROM cw LEFT JOIN st ON cw.ticker = st.ticker"""
    return round_sql(inner, ["portfolio_id", "ticker", "current_weight", *names], {"current_weight", *names},
                     {n: 4 for n in names})


def q_equal_allocations():
    inner = f"""WITH {BRAND}, {CURRENT},
b AS (SELECT DISTINCT ticker FROM bbars), p AS (SELECT DISTINCT portfolio_id FROM cw)
SELECT p.portfolio_id, b.ticker, cw.weight AS current_weight, 1.0 / (SELECT count(*) FROM b) AS new_weight,
  1.0 / (SELECT count(*) FROM b) - coalesce(cw.weight, 0.0) AS change
FROM p CROSS JOIN b LEFT JOIN cw ON cw.portfolio_id = p.portfolio_id AND cw.ticker = b.ticker"""
    return round_sql(inner, ["portfolio_id", "ticker", "current_weight", "new_weight", "change"],
                     {"current_weight", "new_weight", "change"})


ORACLE = {
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
