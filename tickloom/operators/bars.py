"""E1 — ticks to OHLCV bars.

One hash aggregate; every aggregate (min_by/max_by/max/min/sum/count) is
decomposable, so Spark combines map-side before the shuffle and a hot ticker
costs one partial row per map task, not a third of the data in one reducer.

An operator that needs whole series next takes ``OpenBars``: the ticks combined
map-side the same way, to be closed behind that operator's own exchange, so that
they cross one exchange and not two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.wide import first_rows

GRAINS = ("day", "hour", "week")


def bar_keys(grain: str) -> list:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    if grain == "hour":
        return [F.col("ticker"), F.to_date("ts").alias("date"), F.hour("ts").cast("long").alias("hour")]
    if grain == "week":
        return [F.col("ticker"), F.to_date(F.date_trunc("week", "ts")).alias("date")]
    return [F.col("ticker"), F.to_date("ts").alias("date")]


def ohlcv_bars(ticks: DataFrame, grain: str = "day", price: str = "price",
               volume: str = "volume", closed: bool = True) -> DataFrame | OpenBars:
    """Group ticks into bars.

    ``ticks`` needs ``ticker, ts, price, volume, seq``.  open/close are the
    first/last non-null price by (event time, ``seq``) — deterministic, unlike
    arrival order.  Output: ``ticker, date[, hour], open, high, low, close,
    volume, n_ticks``.  With ``closed=False`` the same bars as ``OpenBars``.
    """
    keys = bar_keys(grain)
    if not closed:
        return OpenBars(ticks, grain, price, volume)
    p = F.col(price)
    order = F.when(p.isNotNull(), F.struct(F.col("ts"), F.col("seq")))
    return ticks.groupBy(*keys).agg(
        F.min_by(p, order).alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, order).alias("close"),
        F.sum(F.col(volume)).alias("volume"),
        F.count(F.lit(1)).alias("n_ticks"),
    )


class OpenBars:
    """Bars of ``ticks`` (double prices and volumes) before their exchange.  A row of
    ``rows`` is a tick that stands for ``_n`` ticks of its bar; ``combine`` leaves a
    bar its first tick, which stands for all, and its last; ``close`` makes bars."""

    def __init__(self, ticks: DataFrame, grain: str, price: str, volume: str):
        self.ticks, self.args = ticks, (grain, price, volume)
        self.schema = ohlcv_bars(ticks, *self.args).schema
        if any(self.schema[c].dataType != T.DoubleType() for c in ("open", "volume")):
            raise ValueError("prices and volumes of open bars are doubles")
        self.columns = self.schema.fieldNames()
        self.keys = [c for c in self.columns if c in ("ticker", "date", "hour")]
        seq = ticks.schema["seq"].dataType
        seq = [f"seq.{c}" for c in seq.fieldNames()] if isinstance(seq, T.StructType) else ["seq"]
        self.orders = [f"_o{i}" for i in range(1 + len(seq))]
        p = F.col(price)
        self.rows = ticks.select(*bar_keys(grain), *[F.col(c).alias(o) for c, o in zip(["ts", *seq], self.orders)],
                                 p.alias("_price"), p.alias("_high"), p.alias("_low"), F.col(volume).alias("_volume"),
                                 F.lit(1).cast("long").alias("_n"))

    def count(self) -> int:
        """Bars, at most."""
        return self.ticks.count()

    def of(self, tickers: DataFrame) -> DataFrame:
        """The bars of some tickers."""
        return ohlcv_bars(self.ticks.join(tickers, "ticker", "left_semi"), *self.args)

    def combining(self):
        keys, orders = self.keys, self.orders
        return lambda table: combine(table, keys, orders)

    def closing(self):
        keys = self.keys
        return lambda table: close(table, keys)


def combine(table: pa.Table, keys, orders) -> pa.Table:
    """One or two ticks of every bar, in order: the first, with what its ``_n`` ticks
    come to, and the last.  Ticks without a price come last and count."""
    if not table.num_rows:
        return table
    unpriced = table.column("_price").is_null().cast(pa.int8())
    at = pc.sort_indices(table.append_column("_unpriced", unpriced), null_placement="at_start",
                         sort_keys=[(c, "ascending") for c in (*keys, "_unpriced", *orders)])
    table = table.take(at).combine_chunks()
    starts = first_rows(table, keys)
    priced = table.column("_price").is_valid().to_numpy()
    before = np.concatenate([[0], np.cumsum(priced)])
    known = before[np.append(starts[1:], table.num_rows)] - before[starts]
    some = known > 0

    def over(c, reduce):
        out = np.full(len(starts), np.nan)
        values = table.column(c).to_numpy()[priced]
        out[some] = reduce.reduceat(values, before[starts[some]]) if len(values) else []
        return pa.array(out, pa.float64(), mask=~some)

    there = table.column("_volume").is_valid().to_numpy()
    traded = np.add.reduceat(np.where(there, table.column("_volume").to_numpy(), 0.0), starts)
    new = {"_high": over("_high", np.maximum), "_low": over("_low", np.fmin),  # NaN is the largest double
           "_volume": pa.array(traded, pa.float64(), mask=np.add.reduceat(there.astype(np.int64), starts) == 0),
           "_n": pa.array(np.add.reduceat(table.column("_n").to_numpy(), starts), pa.int64())}
    two = np.flatnonzero(known > 1)
    last = table.take(pa.array(starts[two] + known[two] - 1))
    alone = {"_high": last.column("_price"), "_low": last.column("_price"),
             "_volume": pa.nulls(len(two), pa.float64()), "_n": pa.array(np.zeros(len(two), np.int64))}

    def changed(rows, to):
        return pa.table({c: to.get(c, rows.column(c)) for c in table.column_names}, schema=table.schema)

    both = pa.concat_tables([changed(table.take(pa.array(starts)), new), changed(last, alone)])
    return both.take(pa.array(np.argsort(np.concatenate([np.arange(len(starts)), two]), kind="stable"))).combine_chunks()


def close(table: pa.Table, keys) -> pa.Table:
    """The bars of combined ticks, ordered by ``keys`` with missing ones last."""
    starts = first_rows(table, keys)
    first, last = table.take(pa.array(starts)), table.take(pa.array(np.append(starts[1:], table.num_rows)[: len(starts)] - 1))
    bars = pa.table({**{c: first.column(c) for c in keys}, "open": first.column("_price"), "high": first.column("_high"),
                     "low": first.column("_low"), "close": last.column("_price"), "volume": first.column("_volume"),
                     "n_ticks": first.column("_n")})
    return bars.take(pc.sort_indices(bars, sort_keys=[(c, "ascending") for c in keys], null_placement="at_end"))
