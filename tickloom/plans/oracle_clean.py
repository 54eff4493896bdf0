"""DuckDB oracle for event bars, cleaning, normalisation, split and quality."""

from __future__ import annotations

from tickloom.plans.contracts import digits
from tickloom.plans.oracle import BAR_COLS, BAR_DBL, BARS, ordkey
from tickloom.plans.oracle_market import BRAND
from tickloom.plans.rounding import round_sql

HW = "PARTITION BY ticker ORDER BY date, hour"
HB_COLS = ["ticker", "date", "hour", "open", "high", "low", "close", "volume", "n_ticks"]

HBARS = f"""et AS (
  SELECT event_type AS ticker, ts, CAST(ts AS DATE) AS date, hour(ts) AS hour, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume, event_id AS k1
  FROM events),
hbars AS (
  SELECT ticker, date, hour,
    arg_min(price, {ordkey('ts', 'k1')}) FILTER (WHERE price IS NOT NULL) AS open,
    max(price) AS high, min(price) AS low,
    arg_max(price, {ordkey('ts', 'k1')}) FILTER (WHERE price IS NOT NULL) AS close,
    sum(volume) AS volume, count(*) AS n_ticks
  FROM et GROUP BY ticker, date, hour)"""


def _repair(c: str, w: str) -> str:
    v = f"CASE WHEN {c} > 0 THEN {c} END"
    p = f"last_value({v} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    n = f"first_value({v} IGNORE NULLS) OVER ({w} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    return f"CASE WHEN {c} > 0 THEN {c} ELSE coalesce(({p} + {n}) / 2, {p}, {n}, 100.0) END AS {c}"


def _z(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 0.0 ELSE {c} END AS {c}"


CLEAN = f""",
hz AS (SELECT ticker, date, hour, {', '.join(_z(c) for c in ('open', 'high', 'low', 'close', 'volume'))}, n_ticks FROM hbars),
hc AS (SELECT ticker, date, hour, {', '.join(_repair(c, HW) for c in ('open', 'high', 'low', 'close'))},
         greatest(volume, 1000.0) AS volume, n_ticks FROM hz)"""


def q_hourly_event_bars() -> str:
    return round_sql(f"WITH {HBARS} SELECT * FROM hbars", HB_COLS, BAR_DBL, digits("hourly_event_bars"))


def q_clean_event_bars() -> str:
    return round_sql(f"WITH {HBARS}{CLEAN} SELECT * FROM hc", HB_COLS, BAR_DBL,
                     digits("clean_event_bars"))


def q_normalized_event_bars() -> str:
    whole = f"OVER ({HW} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"

    def reb(c):
        ref = f"first_value(CASE WHEN {c} > 0 THEN {c} END IGNORE NULLS) {whole}"
        return f"CASE WHEN {ref} IS NULL THEN 1.0 ELSE {c} / {ref} END AS {c}"
    inner = f"""WITH {HBARS}{CLEAN}
SELECT ticker, date, hour, {', '.join(reb(c) for c in ('open', 'high', 'low', 'close'))},
  CASE WHEN max(volume) OVER (PARTITION BY ticker) > 0 THEN volume / max(volume) OVER (PARTITION BY ticker)
       ELSE 0.1 END AS volume, n_ticks
FROM hc"""
    return round_sql(inner, HB_COLS, BAR_DBL, digits("normalized_event_bars"))


def q_chrono_split() -> str:
    inner = f"""WITH {BARS},
cal AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS period, count(*) OVER () AS n
        FROM (SELECT DISTINCT date FROM bars)),
cut AS (SELECT date, period,
          CASE WHEN period < greatest(10, least(CAST(floor(n * 0.7) AS BIGINT), n - 10)) THEN 'train'
               ELSE 'test' END AS split FROM cal)
SELECT b.*, c.period, c.split FROM bars b LEFT JOIN cut c ON b.date = c.date"""
    return round_sql(inner, BAR_COLS + ["period", "split"], BAR_DBL, digits("chrono_split"))


def q_interpolated_panel() -> str:
    pw = "PARTITION BY ticker ORDER BY date"
    cols = ("open", "high", "low", "close", "volume")
    parts = []
    for c in cols:
        parts.append(f"""
  min(CASE WHEN {c} IS NOT NULL THEN rn END) OVER (PARTITION BY ticker) AS f_{c},
  max(CASE WHEN {c} IS NOT NULL THEN rn END) OVER (PARTITION BY ticker) AS l_{c},
  first_value({c} IGNORE NULLS) OVER ({pw} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fv_{c},
  last_value({c} IGNORE NULLS) OVER ({pw} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lv_{c},
  first_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER ({pw} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS m_{c},
  first_value({c} IGNORE NULLS) OVER ({pw} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS mv_{c}""")
    fills = []
    for c in cols:
        rho = f"(CAST(rn - f_{c} AS DOUBLE) / (m_{c} - f_{c}))"
        fills.append(f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN f_{c} IS NULL THEN 1.0
  WHEN rn < f_{c} THEN fv_{c} WHEN rn > l_{c} THEN lv_{c}
  ELSE fv_{c} * (1 - {rho}) + mv_{c} * {rho} END AS {c}""")
    inner = f"""WITH {BRAND},
p0 AS (SELECT g.ticker, g.date, b.open, b.high, b.low, b.close, b.volume,
              row_number() OVER (PARTITION BY g.ticker ORDER BY g.date) AS rn
       FROM grid g LEFT JOIN bbars b ON g.ticker = b.ticker AND g.date = b.date),
p1 AS (SELECT *, {','.join(parts)} FROM p0)
SELECT ticker, date, {', '.join(fills)} FROM p1"""
    return round_sql(inner, ["ticker", "date", "open", "high", "low", "close", "volume"], BAR_DBL,
                     digits("interpolated_panel"))


def q_latest_window() -> str:
    inner = f"""WITH {BARS}
SELECT ticker, date, open, high, low, close, volume, n_ticks FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS k FROM bars) WHERE k <= 30"""
    return round_sql(inner, BAR_COLS, BAR_DBL, digits("latest_window"))


def _nulls(cols):
    return " + ".join(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in cols)


def q_ingest_summary() -> str:
    inner = f"""WITH {BARS},
g AS (SELECT count(*) AS n_rows, {_nulls(BAR_COLS)} AS missing_cells, min(date) AS start_date,
             max(date) AS end_date, count(DISTINCT ticker) AS n_tickers FROM bars)
SELECT n_rows, 8 AS n_cols, CAST(missing_cells AS BIGINT) AS missing_cells,
  CASE WHEN n_rows * 8 = 0 THEN NULL ELSE missing_cells / (n_rows * 8) END AS missing_ratio,
  CASE WHEN n_rows * 8 = 0 THEN NULL ELSE missing_cells / (n_rows * 8) > 0.5 END AS missing_warning,
  start_date, end_date, n_tickers FROM g"""
    cols = ["n_rows", "n_cols", "missing_cells", "missing_ratio", "missing_warning", "start_date",
            "end_date", "n_tickers"]
    return round_sql(inner, cols, {"missing_ratio"})


def q_validate_dataset() -> str:
    bad = " OR ".join(f"{c} IS NULL OR isnan({c}) OR isinf({c})" for c in ("open", "high", "low", "close", "volume"))
    inner = f"""WITH {BARS},
g AS (SELECT count(DISTINCT ticker) AS n_tickers, count(DISTINCT date) AS n_periods,
             CAST(sum(CASE WHEN {bad} THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid FROM bars)
SELECT 5 AS n_features, n_tickers, n_periods, n_invalid,
  CASE WHEN n_tickers < 2 OR n_periods < 30 OR n_invalid > 0 THEN false ELSE true END AS valid,
  CASE WHEN n_tickers < 2 THEN 'fewer than 2 tickers' WHEN n_periods < 30 THEN 'fewer than 30 periods'
       WHEN n_invalid > 0 THEN 'NaN or infinite values' ELSE 'ok' END AS reason
FROM g"""
    return round_sql(inner, ["n_features", "n_tickers", "n_periods", "n_invalid", "valid", "reason"], set())


def q_data_quality_gate() -> str:
    cols = ["ticker", "date", "step", "open", "high", "low", "close", "volume"]
    inner = f"""WITH {BRAND},
g AS (SELECT count(*) AS n_rows, {_nulls(cols)} AS n_null,
             min(date) AS start_date, max(date) AS end_date FROM panel)
SELECT n_rows, 8 AS n_cols, CAST(n_null AS BIGINT) AS n_null, start_date, end_date,
  1 - (CASE WHEN n_rows * 8 = 0 THEN NULL ELSE n_null / (n_rows * 8) END) AS quality_score,
  NOT (n_rows = 0 OR n_null > 0.1 * n_rows) AS passed,
  CASE WHEN n_rows = 0 THEN 'empty' WHEN n_null > 0.1 * n_rows THEN 'too many missing values' ELSE 'ok' END AS reason
FROM g"""
    return round_sql(inner, ["n_rows", "n_cols", "n_null", "start_date", "end_date", "quality_score",
                             "passed", "reason"], {"quality_score"})


def q_stream_hourly_bars() -> str:
    inner = f"WITH {HBARS} SELECT * FROM hbars"
    return round_sql(inner, HB_COLS, BAR_DBL, digits("stream_hourly_bars"))


ORACLE = {
    "stream_hourly_bars": q_stream_hourly_bars,
    "hourly_event_bars": q_hourly_event_bars,
    "clean_event_bars": q_clean_event_bars,
    "normalized_event_bars": q_normalized_event_bars,
    "chrono_split": q_chrono_split,
    "interpolated_panel": q_interpolated_panel,
    "latest_window": q_latest_window,
    "ingest_summary": q_ingest_summary,
    "validate_dataset": q_validate_dataset,
    "data_quality_gate": q_data_quality_gate,
}
