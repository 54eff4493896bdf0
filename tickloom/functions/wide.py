"""All technical, price and volume features of one bar series in one pass.

The stages of ``indicators`` are window expressions; each trailing frame is
aggregated again for every row, which for the ninety columns of the full stack costs
far more than moving the columns.  Here rows
sorted by series stream through Arrow and many whole series are worked on at once:
their narrow bars cross once, every frame is a view of one array of all of them,
frames that reach into the series before are left out, and the columns come back
once.  A task holds a few batches or its longest series, one calendar of bars.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view

from tickloom.functions.recurrence import EMA_COLS, ema_frame

SQRT252 = math.sqrt(252.0)
WINDOWS = (5, 10, 20, 60)
BARS = ("high", "low", "close", "volume")


def ratio(a, b) -> np.ndarray:
    """a / b, missing where b is zero."""
    return a / np.where(b == 0, np.nan, b)


def first_rows(table: pa.Table, keys) -> np.ndarray:
    """Positions where a new series starts, in rows sorted by ``keys`` (a NULL key
    is a key)."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        cells = table.column(k).combine_chunks().dictionary_encode(null_encoding="encode")
        cells = cells.combine_chunks() if isinstance(cells, pa.ChunkedArray) else cells
        new[1:] |= np.diff(cells.indices.to_numpy(zero_copy_only=False)) != 0
    return np.flatnonzero(new)


#: Rows of whole series worked on at once.
SERIES_ROWS = 1 << 15


def whole_series(batches, keys, rows: int = SERIES_ROWS):
    """Tables of whole series, about ``rows`` long, from record batches whose rows
    come sorted by ``keys``; the last series of a batch waits for its other rows."""
    held, size, due = [], 0, rows
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < due:
            continue
        table = pa.Table.from_batches(held)
        cut = int(first_rows(table, keys)[-1])
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        held, size = table.to_batches(), table.num_rows
        due = max(rows, 2 * size)  # a long series is looked at a few times only
    if held:
        yield pa.Table.from_batches(held)


class Series:
    """Where the series lie in arrays that hold them one after another: each row's
    series, its place in it and the end of its series."""

    def __init__(self, starts: np.ndarray, n: int):
        length = np.diff(starts, append=n)
        self.ids = np.repeat(np.arange(len(starts)), length)
        self.place = np.arange(n) - np.repeat(starts, length)
        self.end = np.repeat(starts + length, length)

    @classmethod
    def one(cls, n: int) -> Series:
        return cls(np.zeros(min(n, 1), np.int64), n)

    def frames(self, x: np.ndarray) -> Frames:
        return Frames(x, self.place)

    def shifted(self, x: np.ndarray, n: int = 1) -> np.ndarray:
        out = np.concatenate([np.full(min(n, len(x)), np.nan), x[: max(len(x) - n, 0)]])
        out[self.place < n] = np.nan
        return out

    def next_valid(self, x: np.ndarray) -> np.ndarray:
        """Missing values replaced by the series' next one; trailing ones stay."""
        at = np.where(np.isnan(x), len(x), np.arange(len(x)))
        at = np.minimum.accumulate(at[::-1])[::-1]
        return np.where(at < self.end, np.append(x, np.nan)[at], np.nan)

    def total(self, x: np.ndarray) -> np.ndarray:
        """Running sum."""
        return pd.Series(x).groupby(self.ids).cumsum().to_numpy()


def next_valid(x: np.ndarray) -> np.ndarray:
    return Series.one(len(x)).next_valid(x)


class Frames:
    """Aggregates over the trailing ``n`` values of a series, missing until all are
    present; the deviation of equal values is exactly zero."""

    STEP = 1 << 13  # frames laid out at once

    def __init__(self, x: np.ndarray, place: np.ndarray):
        self.x, self.place = x, place

    def _over(self, n: int, fn) -> np.ndarray:
        out = np.full(len(self.x), np.nan)
        if len(self.x) >= n:
            views = sliding_window_view(self.x, n)
            for a in range(0, len(views), self.STEP):
                w = views[a: a + self.STEP]
                out[n - 1 + a: n - 1 + a + len(w)] = fn(w)
            out[self.place < n - 1] = np.nan
        return out

    def mean(self, n):
        return self._over(n, lambda w: w.mean(1))

    def total(self, n):
        return self._over(n, lambda w: w.sum(1))

    def most(self, n):
        return self._over(n, lambda w: w.max(1))

    def least(self, n):
        return self._over(n, lambda w: w.min(1))

    def deviation(self, n, ddof):
        def spread(w):
            centred = w - w.mean(1, keepdims=True)
            out = np.sqrt(np.einsum("ij,ij->i", centred, centred) / (n - ddof))
            return np.where(w.max(1) == w.min(1), 0.0, out)
        return self._over(n, spread)


def quiet(fn):
    """Divisions by zero and missing values are results here, not warnings."""
    def run(*args, **kwargs):
        with warnings.catch_warnings(), np.errstate(all="ignore"):
            warnings.simplefilter("ignore")
            return fn(*args, **kwargs)
    return run


def ema_features(close: np.ndarray, s: Series, window: int = 14) -> dict[str, np.ndarray]:
    return {k: x.to_numpy(np.float64) for k, x in ema_frame(pd.Series(close), window, ids=s.ids).items()}


@quiet
def technical_features(bars: dict[str, np.ndarray], s: Series, window: int = 14, vol_window: int = 30) -> dict[str, np.ndarray]:
    """The technical stage but the EMA family."""
    high, low, close, volume = (bars[c] for c in ("high", "low", "close", "volume"))
    c = s.frames(close)
    out = {"SMA": c.mean(window)}
    lowest, highest = s.frames(low).least(window), s.frames(high).most(window)
    band = 2 * c.deviation(window, 0)
    out["Stoch"] = 100 * ratio(close - lowest, highest - lowest)
    out["Stoch_Signal"] = s.frames(out["Stoch"]).mean(3)
    out["BB_High"], out["BB_Low"] = out["SMA"] + band, out["SMA"] - band
    out["BB_Width"] = ratio(out["BB_High"] - out["BB_Low"], close)
    out["Returns"] = ratio(close, s.shifted(close)) - 1
    out["Volatility"] = s.frames(out["Returns"]).deviation(vol_window, 1) * SQRT252
    out["Volume_SMA"] = s.frames(volume).mean(window)
    out["Volume_Change"] = ratio(volume, s.shifted(volume)) - 1
    return out


@quiet
def price_features(bars: dict[str, np.ndarray], s: Series, windows=WINDOWS) -> dict[str, np.ndarray]:
    high, low, close = (bars[c] for c in ("high", "low", "close"))
    c, before = s.frames(close), s.shifted(close)
    out = {"Daily_Return": ratio(close, before) - 1}
    for n in windows:
        out |= {f"Return_{n}d": ratio(close, s.shifted(close, n)) - 1, f"MA_{n}d": c.mean(n), f"Std_{n}d": c.deviation(n, 1),
                f"Max_{n}d": c.most(n), f"Min_{n}d": c.least(n)}
    span, up, down = high - low, np.abs(high - before), np.abs(low - before)
    out |= {"High_Low": span, "High_PrevClose": up, "Low_PrevClose": down,
            "True_Range": np.fmax(span, np.fmax(up, down))}
    true_range = s.frames(out["True_Range"])
    for n in windows:
        mean = out[f"MA_{n}d"]
        out |= {f"Price_to_MA_{n}d": ratio(close, mean), f"Price_MA_{n}d_Gap": ratio(close - mean, mean) * 100,
                f"ATR_{n}d": true_range.mean(n)}
    return out


@quiet
def volume_features(bars: dict[str, np.ndarray], s: Series, windows=WINDOWS) -> dict[str, np.ndarray]:
    high, low, close, volume = (bars[c] for c in ("high", "low", "close", "volume"))
    v = s.frames(volume)
    flow = s.frames(ratio((close - low) - (high - close), high - low) * volume)
    out = {"Volume_Change": ratio(volume, s.shifted(volume)) - 1}
    out |= {f"Volume_MA_{n}d": v.mean(n) for n in windows}
    out |= {f"CMF_{n}d": ratio(flow.total(n), v.total(n)) for n in windows}
    out["OBV"] = s.total(np.nan_to_num(np.sign(close - s.shifted(close)) * volume))
    return out | {f"Volume_Ratio_{n}d": ratio(volume, out[f"Volume_MA_{n}d"]) for n in windows}


def wide_features(bars: dict[str, np.ndarray], window: int = 14, vol_window: int = 30, ema: bool = True,
                  s: Series | None = None) -> dict[str, np.ndarray]:
    """Every feature of ordered series (one by default); missing values are NaN."""
    s = s or Series.one(len(bars["close"]))
    technical = technical_features(bars, s, window, vol_window)
    change = technical.pop("Volume_Change")
    recurrent = ema_features(bars["close"], s, window) if ema else {}
    traded = volume_features(bars, s)
    traded.pop("Volume_Change")
    return {"SMA": technical.pop("SMA"), **recurrent, **technical, **price_features(bars, s), **traded, "Volume_Change": change}


def finite_or_null(x) -> pa.Array:
    x = pa.array(x, pa.float64(), from_pandas=True)
    return pc.if_else(pc.is_finite(x), x, pa.scalar(None, x.type))


def feature_names(ema: bool = True) -> list[str]:
    """The features' names in order."""
    empty = np.zeros(0)
    names = list(wide_features({c: empty for c in BARS}, ema=False))
    return names if not ema else [names[0], *EMA_COLS, *names[1:]]
