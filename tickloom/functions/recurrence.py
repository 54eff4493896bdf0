"""Exponential recurrences (EMA family, Wilder RSI) — the one place the
indicator library needs more than frames.

A first-order recurrence has no Spark built-in.  Each ticker's bar series is
bounded by the calendar (one row per trading period); ``indicators`` streams whole
series through Arrow and many of them are smoothed in one vectorised ``ewm``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
EMA_COLS = ("EMA", "MACD", "MACD_Signal", "MACD_Diff", "RSI")


def _ewm(s: pd.Series, span=None, alpha=None, min_periods=0, ids=None) -> pd.Series:
    rows = s if ids is None else s.groupby(ids)
    y = rows.ewm(span=span, alpha=alpha, adjust=False, min_periods=min_periods).mean()
    return y if ids is None else pd.Series(y.to_numpy(), index=s.index)


def ema_frame(close: pd.Series, window: int = 14, fast: int = 12, slow: int = 26,
              signal: int = 9, ids: np.ndarray | None = None) -> pd.DataFrame:
    """Published indicator definitions on one ordered close series, or on several,
    one after another, which ``ids`` numbers in ascending order."""
    if ids is not None and not len(ids):
        ids = None
    ema = _ewm(close, span=window, min_periods=window, ids=ids)
    macd = _ewm(close, span=fast, min_periods=fast, ids=ids) - _ewm(close, span=slow, min_periods=slow, ids=ids)
    sig = _ewm(macd, span=signal, min_periods=signal, ids=ids)
    diff = close.diff(1)
    if ids is not None:
        diff[np.flatnonzero(np.diff(ids, prepend=-1))] = np.nan
    up = diff.where(diff > 0, 0.0)
    dn = -diff.where(diff < 0, 0.0)
    eu = _ewm(up, alpha=1.0 / window, min_periods=window, ids=ids)
    ed = _ewm(dn, alpha=1.0 / window, min_periods=window, ids=ids)
    rsi = pd.Series(np.where(ed == 0, 100.0, 100.0 - 100.0 / (1.0 + eu / ed)), index=close.index)
    rsi[eu.isna() | ed.isna()] = np.nan
    return pd.DataFrame({"EMA": ema, "MACD": macd, "MACD_Signal": sig,
                         "MACD_Diff": macd - sig, "RSI": rsi})
