"""F1–F33 — the indicator library over bars.

The technical, price and volume stages take one hash exchange of the narrow bars on
the series key and a sort by (key, order), the full stack with partners one exchange of
compressed blocks (``functions.packed``); sorted rows stream through Arrow, many whole
series at a time (``functions.wide``).  A trailing frame is
a view of an array there, where a window function aggregates it anew for every row.
A series is bounded by the calendar (trading days), not by tick volume, so a hot
ticker never puts more than one calendar of rows into memory.

Conventions follow pandas: frames of n are NULL until n non-null values
are present; division by zero yields NULL (pandas: inf).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.core import backfill_all, full, series_window, td
from tickloom.functions.wide import (BARS, SERIES_ROWS, Series, ema_features, feature_names, finite_or_null, first_rows,
                                     price_features, technical_features, volume_features, whole_series, wide_features)
from tickloom.operators.bars import OpenBars

SQRT252 = math.sqrt(252.0)


def _series_pass(fields, names, compute, keys, read, kept):
    """The schema of the columns ``kept`` and ``names``, and what makes them of a
    table of whole series in order."""
    fields = {f.name: f for f in fields} | {c: T.StructField(c, T.DoubleType()) for c in names}
    schema = T.StructType([fields[c] for c in dict.fromkeys([*kept, *names])])

    def made(table):
        x = {c: table.column(c).to_numpy().astype(np.float64) for c in read}
        new = compute(x, Series(first_rows(table, keys), table.num_rows), table)
        out = {c: table.column(c) for c in kept} | {c: finite_or_null(new[c]) for c in names}
        return pa.table({c: out[c] for c in schema.fieldNames()})

    return schema, made


def series_columns(bars: DataFrame, names, compute, key="ticker", order="date", nulls_first: bool = True,
                   read=BARS, kept=None) -> DataFrame:
    """``bars`` (its columns ``kept``, all by default) and the double columns
    ``names``, which ``compute`` finds from the arrays ``read`` of whole series in
    order; its other arguments are their ``Series`` and Arrow table."""
    keys = [key] if isinstance(key, str) else list(key)
    orders = [F.col(o).asc() if nulls_first else F.col(o).asc_nulls_last()
              for o in ([order] if isinstance(order, str) else order)]
    kept = list(bars.columns if kept is None else kept)
    schema, made = _series_pass(bars.schema.fields, names, compute, keys, read, kept)

    def run(batches):
        for table in whole_series(batches, keys):
            yield from made(table).to_batches(10_000)

    return bars.repartition(*keys).sortWithinPartitions(*keys, *orders).mapInArrow(run, schema)


def _filled(new: dict, s: Series, backfill: bool) -> dict:
    return {c: s.next_valid(v) for c, v in new.items()} if backfill else new


# ---------------------------------------------------------------- F-T technical
TECH_COLS = ["SMA", "EMA", "MACD", "MACD_Signal", "MACD_Diff", "RSI", "Stoch", "Stoch_Signal",
             "BB_High", "BB_Low", "BB_Width", "Returns", "Volatility", "Volume_SMA", "Volume_Change"]


def add_technical_indicators(bars: DataFrame, window: int = 14, vol_window: int = 30,
                             backfill: bool = True, key: str = "ticker",
                             order: str = "date") -> DataFrame:
    """SMA EMA MACD MACD_Signal MACD_Diff RSI Stoch Stoch_Signal BB_High BB_Low
    BB_Width Returns Volatility Volume_SMA Volume_Change.  A row without a date is
    the first of its series, for the recursive EMA family the last."""
    date = order if isinstance(order, str) else order[0]

    def compute(x, s, table):
        missing = table.column(date).is_null().to_numpy()
        at = np.lexsort((missing, s.ids))  # stable: each series, its undated rows last
        new = technical_features(x, s, window, vol_window)
        for c, v in ema_features(x["close"][at], s, window).items():
            new[c] = np.empty(len(v))
            new[c][at] = np.where(np.isfinite(v), v, np.nan)
        return _filled(new, s, backfill)

    return series_columns(bars, TECH_COLS, compute, key, order, kept=bars.columns)


# ---------------------------------------------------------------- F-P price
def add_price_features(bars: DataFrame, windows=(5, 10, 20, 60), backfill: bool = True,
                       key: str = "ticker", order: str = "date") -> DataFrame:
    nothing = {c: np.zeros(0) for c in BARS}
    names = list(price_features(nothing, Series.one(0), windows))
    return series_columns(bars, names, lambda x, s, table: _filled(price_features(x, s, windows), s, backfill),
                          key, order, read=("high", "low", "close"))


# ---------------------------------------------------------------- F-V volume
def add_volume_features(bars: DataFrame, windows=(5, 10, 20, 60), backfill: bool = True,
                        key: str = "ticker", order: str = "date") -> DataFrame:
    nothing = {c: np.zeros(0) for c in BARS}
    names = list(volume_features(nothing, Series.one(0), windows))
    return series_columns(bars, names, lambda x, s, table: _filled(volume_features(x, s, windows), s, backfill),
                          key, order, kept=[c for c in bars.columns if c != "Volume_Change"])


# ---------------------------------------------------------------- F-C cross-asset
def _pair_moments(x, y, w, n):
    """Rolling sample covariance / correlation over rows where both are
    present; NULL until the frame holds n such rows (pandas pairwise rolling).
    ``corr`` is NOT used: it raises on a constant frame under ANSI."""
    both = x.isNotNull() & y.isNotNull()
    xb, yb = F.when(both, x), F.when(both, y)
    fr = w.rowsBetween(-(n - 1), 0)
    ok = F.count(xb).over(fr) == n
    cov = F.covar_samp(xb, yb).over(fr)
    den = F.stddev_samp(xb).over(fr) * F.stddev_samp(yb).over(fr)
    return F.when(ok, cov), F.when(ok, td(cov, den))


def add_correlation_features(panel: DataFrame, partners: DataFrame, windows=(10, 20, 60),
                             backfill: bool = True, value: str = "close") -> DataFrame:
    """rolling correlation of price LEVELS for the pairs of
    ``partners(ticker, other)``, long form (ticker, other, date, Corr_{n}d)."""
    from tickloom.operators.correlation import pair_correlations
    return pair_correlations(panel, partners, windows, backfill, value)


PARTNER_WINDOWS = (10, 20, 60)


def partner_columns(bars: DataFrame | OpenBars, partners: DataFrame, ranks: int = 1, windows=PARTNER_WINDOWS) -> DataFrame:
    """F28 wide: ``bars`` with Corr_{rank}_{n}d, the correlation with the
    ticker's partner of that rank (``partners(ticker, other, rank)``, rank from 1);
    NULL on dates the partner has no bar."""
    from tickloom.operators.correlation import beside_partners
    schema = T.StructType([*bars.schema.fields, *[T.StructField(c, T.DoubleType()) for c in partner_names(ranks, windows)]])
    return beside_partners(bars, partners, ranks, windows, lambda table: [table], schema)


def partner_names(ranks: int = 1, windows=PARTNER_WINDOWS) -> list[str]:
    return [f"Corr_{r}_{n}d" for r in range(1, ranks + 1) for n in windows]


# ---------------------------------------------------------------- F-M market
RF_DAILY = 0.01 / 252  # Fixed value: 1 % a year, daily.


def add_market_features(bars: DataFrame, market: DataFrame, windows=(5, 10, 20, 60),
                        backfill: bool = True, rf: float = RF_DAILY) -> DataFrame:
    """F29–F32 against a market series ``market(date, close)`` aligned to each
    bar date by a backward as-of join (D1): Beta, Alpha, Market_Corr and
    Rel_Strength per window.  Market returns are taken on the ALIGNED series
    (previous bar date's market level), as the reference does."""
    from tickloom.operators.joins import asof_join
    m = market.select("date", F.col("close").alias("m_close"))
    df = asof_join(bars, m, on="date")
    w = series_window("ticker", "date")
    c, mc = F.col("close"), F.col("m_close")
    df = df.select("*", (td(c, F.lag(c).over(w)) - 1).alias("_rs"),
                   (td(mc, F.lag(mc).over(w)) - 1).alias("_rm"))
    rs, rm = F.col("_rs"), F.col("_rm")
    out = [F.col(x) for x in df.columns]
    names = []
    for n in windows:
        cov, corr = _pair_moments(rs, rm, w, n)
        var = full(F.var_samp(rm), rm, w, n)
        beta = td(cov, var)
        alpha = full(F.avg(rs), rs, w, n) - rf - beta * (full(F.avg(rm), rm, w, n) - rf)
        rel = td(td(c, F.lag(c, n).over(w)), td(mc, F.lag(mc, n).over(w)))
        out += [beta.alias(f"Beta_{n}d"), alpha.alias(f"Alpha_{n}d"),
                corr.alias(f"Market_Corr_{n}d"), rel.alias(f"Rel_Strength_{n}d")]
        names += [f"Beta_{n}d", f"Alpha_{n}d", f"Market_Corr_{n}d", f"Rel_Strength_{n}d"]
    res = df.select(*out).drop("_rs", "_rm")
    return backfill_all(res, names) if backfill else res


# ---------------------------------------------------------------- F33
def feature_stack(bars: DataFrame | OpenBars, backfill: bool = True, partners: DataFrame | None = None,
                  ranks: int = 1, ema: bool = True) -> DataFrame:
    """technical, price, volume and correlation stages on one bar table.
    Correlations are those with the partners that ``partners(ticker, other,
    rank)`` names (none without it); with them, or with open bars, the bars cross
    their one exchange in compressed blocks and each part gets all stages in one
    pass.  ``ema=False`` leaves the recurrences out."""
    from tickloom.operators.correlation import beside_partners
    base = list(bars.columns)
    corr = [] if partners is None else partner_names(ranks)
    names = feature_names(ema)
    read, kept = (*BARS, *corr), [c for c in base if c not in names]

    def compute(x, s, table):
        return _filled(wide_features(x, ema=ema, s=s) | {c: x[c] for c in corr}, s, backfill)

    if partners is None and isinstance(bars, DataFrame):
        return series_columns(bars, names, compute, nulls_first=False, read=read, kept=kept)
    schema, made = _series_pass(bars.schema.fields, [*names, *corr], compute, ["ticker"], read, kept)

    def stages(table):
        for some in whole_series(table.to_batches(SERIES_ROWS // 4), ["ticker"]):
            yield made(some)

    return beside_partners(bars, partners, ranks, PARTNER_WINDOWS, stages, schema)


# Named indicator stages, applied with ``df.transform`` — user stages
# register the same way (any ``DataFrame -> DataFrame`` on bars).
STAGES = {
    "technical": add_technical_indicators,
    "price": add_price_features,
    "volume": add_volume_features,
}


def register_stage(name: str, fn) -> None:
    STAGES[name] = fn


def apply_stages(bars: DataFrame, names) -> DataFrame:
    out = bars
    for n in names:
        out = out.transform(STAGES[n])
    return out
