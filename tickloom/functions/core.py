"""Column-expression helpers shared by every operator.

All helpers return JVM-side Column expressions (whole-stage codegen friendly);
nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

UNB = Window.unboundedPreceding
UNF = Window.unboundedFollowing


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def td(a, b) -> Column:
    """Division that yields NULL for x/0 (ANSI ``/`` raises)."""
    return F.try_divide(col(a), col(b))


def nan_to_null(c) -> Column:
    """NaN and +-inf become NULL: NULL is the only 'missing' value in the library."""
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def series_window(key: str | list = "ticker", order: str | list = "date") -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*orders)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """The last ``n`` rows including the current one."""
    return w.rowsBetween(-(n - 1), 0)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(UNB, 0)


def full(agg: Column, c, w: WindowSpec, n: int) -> Column:
    """pandas ``rolling(n)`` default: NULL until the frame holds n non-null values."""
    frame = trailing(w, n)
    return F.when(F.count(col(c)).over(frame) == n, agg.over(frame))


def backfill_all(df, cols, key="ticker", order="date"):
    """Replace NULL by the next non-null value of the series (look-ahead);
    trailing NULLs stay.

    Evaluated as a running ``last(ignorenulls)`` in *descending* order: an
    incremental frame, O(n) per series, sharing one Window node for all
    columns (a CURRENT..UNBOUNDED FOLLOWING frame is recomputed per row).
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    rev = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in orders]) \
        .rowsBetween(UNB, 0)
    return df.select(*[F.last(col(c), ignorenulls=True).over(rev).alias(c) if c in cols
                       else F.col(c) for c in df.columns])


class Rolling:
    """Trailing-frame aggregates computed once per (function, column, n).

    Catalyst evaluates each window expression it is given, including exact
    repeats; indicator stages reuse the same ``count(c)`` / ``avg(c)`` frames
    many times, so expressions are registered here, materialised by
    ``apply`` in one projection (one Window node), then referenced by name."""

    def __init__(self, w: WindowSpec):
        self.w = w
        self.exprs: dict[str, Column] = {}

    def agg(self, fn: str, c: str, n: int) -> Column:
        alias = f"_r_{fn}_{c}_{n}"
        if alias not in self.exprs:
            self.exprs[alias] = getattr(F, fn)(F.col(c)).over(trailing(self.w, n))
        return F.col(alias)

    def full(self, fn: str, c: str, n: int) -> Column:
        """pandas ``rolling(n).fn()``: NULL until n non-null values."""
        return F.when(self.agg("count", c, n) == n, self.agg(fn, c, n))

    def lag(self, c: str, k: int = 1) -> Column:
        alias = f"_r_lag_{c}_{k}"
        if alias not in self.exprs:
            self.exprs[alias] = F.lag(F.col(c), k).over(self.w)
        return F.col(alias)

    def apply(self, df):
        out = df.select("*", *[e.alias(a) for a, e in self.exprs.items()])
        self.exprs = {}
        return out


def drop_temp(df):
    return df.drop(*[c for c in df.columns if c.startswith("_r_")])
