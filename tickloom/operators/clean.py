"""B1–B12 — cleaning, normalisation, split and reshaping of bar series.

All per-series look-ups ("previous valid", "next valid", "first valid") are
running frames — forward for the past, a *descending* running frame for the
future — so each costs O(n) per series and shares the ticker partitioning of
the surrounding windows.  Global ranks (B6) are taken over the distinct
calendar, never over the fact table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.core import UNB, UNF, col

OHLC = ("open", "high", "low", "close")
OHLCV = OHLC + ("volume",)


def _windows(key, order):
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, str) else list(order)
    fwd = Window.partitionBy(*keys).orderBy(*orders)
    rev = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in orders])
    whole = Window.partitionBy(*keys)
    return fwd, rev, whole


def sanitize(bars: DataFrame, cols=OHLCV) -> DataFrame:
    """B1: NaN, ±inf and NULL -> 0.0."""
    def fix(c):
        x = F.col(c)
        return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)) \
            .otherwise(x).alias(c)
    return bars.select(*[fix(c) if c in cols else F.col(c) for c in bars.columns])


def repair_prices(bars: DataFrame, cols=OHLC, key="ticker", order="date",
                  default: float = 100.0) -> DataFrame:
    """B2: a value <= 0 becomes the midpoint of the nearest original valid
    (> 0) values before and after it; one-sided -> that value; none -> 100."""
    fwd, rev, _ = _windows(key, order)
    before = fwd.rowsBetween(UNB, -1)
    after = rev.rowsBetween(UNB, -1)
    out = []
    for c in bars.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        x = F.col(c)
        valid = F.when(x > 0, x)
        p = F.last(valid, ignorenulls=True).over(before)
        n = F.last(valid, ignorenulls=True).over(after)
        out.append(F.when(x > 0, x).otherwise(
            F.coalesce((p + n) / 2, p, n, F.lit(default))).alias(c))
    return bars.select(*out)


def floor_volume(bars: DataFrame, floor: float = 1000.0, volume="volume") -> DataFrame:
    """volume = max(volume, floor)."""
    return bars.withColumn(volume, F.greatest(F.col(volume), F.lit(float(floor))))


def clean_bars(bars: DataFrame, key="ticker", order="date") -> DataFrame:
    """B1 -> B2 -> B3, the reference's ``clean_data`` on a long table."""
    return floor_volume(repair_prices(sanitize(bars), key=key, order=order))


def rebase_prices(bars: DataFrame, cols=OHLC, key="ticker", order="date") -> DataFrame:
    """Each price series divided by its own first valid (> 0) value;
    a series without one becomes 1.0."""
    fwd, _, _ = _windows(key, order)
    whole = fwd.rowsBetween(UNB, UNF)
    out = []
    for c in bars.columns:
        if c in cols:
            x = F.col(c)
            ref = F.first(F.when(x > 0, x), ignorenulls=True).over(whole)
            out.append(F.when(ref.isNull(), F.lit(1.0)).otherwise(x / ref).alias(c))
        else:
            out.append(F.col(c))
    return bars.select(*out)


def scale_volume(bars: DataFrame, key="ticker", volume="volume") -> DataFrame:
    """Volume divided by the series maximum; max <= 0 -> 0.1."""
    m = F.max(volume).over(Window.partitionBy(key))
    return bars.withColumn(volume, F.when(m > 0, F.col(volume) / m).otherwise(F.lit(0.1)))


def normalize_bars(bars: DataFrame, key="ticker", order="date") -> DataFrame:
    return scale_volume(rebase_prices(bars, key=key, order=order), key=key)


def fit_normalizer(bars: DataFrame, cols=OHLC, volume="volume", key="ticker", order="date") -> DataFrame:
    """B4/B5 as a fitted table: per series the first valid (> 0) value of each
    price column and the largest volume of ``bars``, which are the training rows.
    One aggregate that combines before the shuffle; store it beside its split."""
    refs = [F.min_by(F.col(c), F.when(F.col(c) > 0, F.struct(*[F.col(o) for o in ([order] if isinstance(order, str) else order)])))
            .alias(f"ref_{c}") for c in cols]
    return bars.groupBy(key).agg(*refs, F.max(volume).alias(f"ref_{volume}"))


def apply_normalizer(bars: DataFrame, fitted: DataFrame, cols=OHLC, volume="volume", key="ticker") -> DataFrame:
    """Prices over their fitted first value, volume over its fitted maximum; as
    B4/B5 where the training rows hold none: price 1.0, volume 0.1.  A series
    without training rows counts as one without valid values."""
    joined = bars.join(fitted, key, "left")
    scaled = {c: F.when(F.col(f"ref_{c}").isNull(), F.lit(1.0)).otherwise(F.col(c) / F.col(f"ref_{c}")) for c in cols}
    top = F.col(f"ref_{volume}")
    scaled[volume] = F.when(top > 0, F.col(volume) / top).otherwise(F.lit(0.1))
    return joined.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in bars.columns])


def chrono_split(bars: DataFrame, ratio: float = 0.7, clamp: bool = True,
                 order: str = "date") -> DataFrame:
    """Label each row ``train``/``test`` by its date's rank in the distinct
    calendar; split index max(10, min(int(n*ratio), n-10)) when clamped."""
    if not 0 < ratio < 1:
        raise ValueError("ratio must be in (0, 1)")
    cal = bars.select(order).distinct()
    # One ordered pass over the calendar (bounded by the number of periods).
    w = Window.orderBy(order)
    cal = cal.select(order, (F.row_number().over(w) - 1).cast("long").alias("period"),
                     F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))
    cut = F.floor(F.col("_n") * F.lit(ratio)).cast("long")
    if clamp:
        cut = F.greatest(F.lit(10), F.least(cut, F.col("_n") - 10))
    cal = cal.select(order, "period", F.when(F.col("period") < cut, "train")
                     .otherwise("test").alias("split"))
    return bars.join(cal, order, "left")


def interpolate_edges(panel: DataFrame, cols=OHLCV, key="ticker", order="date") -> DataFrame:
    """NULL filling of the simulator: leading NULLs take the first valid
    value, trailing the last; an interior NULL at k, with next valid m and the
    series' FIRST valid index f, becomes x_f·(1−ρ) + x_m·ρ, ρ=(k−f)/(m−f);
    an all-NULL series becomes 1.0."""
    fwd, rev, _ = _windows(key, order)
    whole = fwd.rowsBetween(UNB, UNF)
    rn = F.row_number().over(fwd)
    df = panel.withColumn("_rn", rn)
    out = [F.col(c) for c in panel.columns if c not in cols]
    for c in panel.columns:
        if c not in cols:
            continue
        x = F.col(c)
        pt = F.when(x.isNotNull(), F.struct(F.col("_rn").alias("i"), x.alias("v")))
        first = F.first(pt, ignorenulls=True).over(whole)
        last = F.last(pt, ignorenulls=True).over(whole)
        nxt = F.last(pt, ignorenulls=True).over(rev.rowsBetween(UNB, 0))
        k = F.col("_rn")
        rho = (k - first["i"]) / (nxt["i"] - first["i"])
        val = (F.when(x.isNotNull(), x)
               .when(first.isNull(), F.lit(1.0))
               .when(k < first["i"], first["v"])
               .when(k > last["i"], last["v"])
               .otherwise(first["v"] * (1 - rho) + nxt["v"] * rho))
        out.append(val.alias(c))
    return df.select(*out).select(*panel.columns)


def latest_window(bars: DataFrame, n: int = 30, key="ticker", order="date") -> DataFrame:
    """The last ``n`` periods of every series (all of them when fewer)."""
    _, rev, _ = _windows(key, order)
    return bars.withColumn("_k", F.row_number().over(rev)).filter(F.col("_k") <= n).drop("_k")


def dense_panel(bars: DataFrame, key="ticker", order="date", step="1 day",
                cols=OHLCV) -> DataFrame:
    """Align every series to the union calendar; absent periods are NULL.

    The calendar is generated per series with ``sequence`` between the global
    first and last period (two scalars) and restricted to observed periods by
    a semi-join, so no pairing of tables is needed; the result has exactly
    |series| × |calendar| rows, the panel itself.  Every date lies on the
    default lattice; a coarser ``step`` that misses an observed period raises.
    """
    lo, hi = bars.agg(F.min(order), F.max(order)).first()
    cal = bars.select(order).filter(F.col(order).isNotNull()).distinct()
    if lo is None:
        grid = bars.select(key, order)
    else:
        lattice = F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr(f"INTERVAL {step}"))).alias(order)
        # Checked inside the plan: no job runs while the query is built.
        points = bars.sparkSession.range(1).select(lattice).withColumn("_on", F.lit(True))
        off = F.raise_error(F.lit(f"observed periods lie off a lattice of {step} from {lo}")).cast("boolean")
        cal = cal.join(points, order, "left").filter(F.coalesce(F.col("_on"), off)).select(order)
        grid = bars.select(key).distinct().select(key, lattice)
    grid = grid.join(cal, order, "left_semi")
    keep = [c for c in bars.columns if c in cols]
    return grid.join(bars.select(key, order, *keep), [key, order], "left")


def feature_tensor(features: DataFrame, names, lookback: int = 30, key="ticker",
                   order="date") -> DataFrame:
    """Long tensor (feature, ticker, date, value) over the last
    ``lookback`` dates that every ticker has; absent features are 0."""
    per_date = features.groupBy(order).agg(F.countDistinct(key).alias("_k"))
    total = features.select(key).distinct().agg(F.count(F.lit(1)).alias("_n"))
    common = per_date.join(total, F.col("_k") == F.col("_n")).select(order)
    top = common.select(order, F.row_number().over(Window.orderBy(F.col(order).desc()))
                        .alias("_r")).filter(F.col("_r") <= lookback).select(order)
    kept = features.join(top, order, "left_semi")
    have = set(kept.columns)
    stacked = [F.struct(F.lit(n).alias("feature"),
                        (F.col(n).cast("double") if n in have else F.lit(0.0)).alias("value"))
               for n in names]
    return kept.select(key, order, F.explode(F.array(*stacked)).alias("_f")).select(
        F.col("_f.feature").alias("feature"), key, order, F.col("_f.value").alias("value"))


def _observed(panel: DataFrame, n: int, features, key, order) -> DataFrame:
    """(key, order, _z0, _z1, …): each feature's observation as an array."""
    fwd, _, _ = _windows(key, order)
    frame = fwd.rowsBetween(-n, -1)
    df = panel.select(key, order, *[F.collect_list(F.col(f).cast("double")).over(frame)
                                    .alias(f"_h{i}") for i, f in enumerate(features)])
    x = [F.concat(F.array_repeat(F.lit(0.0), F.lit(n) - F.size(f"_h{i}")), F.col(f"_h{i}")).alias(f"_x{i}")
         for i in range(len(features))]
    df = df.select(key, order, *x)
    df = df.select("*", *[(F.aggregate(f"_x{i}", F.lit(0.0), lambda a, v: a + v) / n).alias(f"_m{i}")
                          for i in range(len(features))])

    def spread(i):
        mean = F.col(f"_m{i}")
        return F.sqrt(F.aggregate(f"_x{i}", F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)) / n).alias(f"_s{i}")

    def scaled(i):
        mean, sd = F.col(f"_m{i}"), F.col(f"_s{i}")
        return F.transform(f"_x{i}", lambda v: F.when(sd > 1e-8, (v - mean) / sd).otherwise(F.lit(0.0))).alias(f"_z{i}")

    places = range(len(features))
    return df.select("*", *[spread(i) for i in places]).select(key, order, *[scaled(i) for i in places])


def observation_tensors(panel: DataFrame, n: int = 30, features=("close",), key="ticker", order="step") -> DataFrame:
    """B12 as one array a row: (key, order, tensor), feature after feature, the
    oldest lag first; n * features values, whatever the table's size."""
    z = _observed(panel, n, features, key, order)
    return z.select(key, order, F.concat(*[F.col(f"_z{i}") for i in range(len(features))]).alias("tensor"))


def observation_windows(panel: DataFrame, n: int = 30, features=("close",), key="ticker",
                        order="step") -> DataFrame:
    """The simulator's observation at step s — rows s−n … s−1 (the
    current row EXCLUDED), left zero-padded when short, then z-scored per
    feature with the population std of the padded window (std ≤ 1e-8 → 0).
    Long form ``(ticker, step, feature, lag, value)``; lag 1 is the oldest."""
    z = _observed(panel, n, features, key, order)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_z{i}").alias("z"))
                               for i, f in enumerate(features)])).alias("_f")
    return z.select(key, order, each).select(key, order, "_f.feature", F.posexplode("_f.z").alias("lag", "value")) \
        .select(key, order, "feature", (F.col("lag") + 1).alias("lag"), "value")


# Substrings selecting each feature category (substring match,
# so "MA" also takes SMA / EMA / MACD columns, as in the reference).
CATEGORY_PATTERNS = {
    "price": ("Open", "High", "Low", "Close", "Return", "MA", "Price"),
    "volume": ("Volume", "OBV", "CMF"),
    "technical": ("SMA", "EMA", "MACD", "RSI", "Stoch", "BB", "Volatility"),
}


def project_category(features: DataFrame, category: str, keys=("ticker", "date")) -> DataFrame:
    """The columns of one feature category (plus the keys)."""
    pats = CATEGORY_PATTERNS[category]
    cols = [c for c in features.columns if c not in keys and any(p in c for p in pats)]
    return features.select(*keys, *cols)
