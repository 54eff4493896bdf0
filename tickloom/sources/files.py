"""A1–A8 — market files: layout detection, wide/long/single readers,
ticker clean-up, date ranges, snapshot inventory and snapshot writes.

Layout decisions look at column NAMES only (driver-side metadata); all data
work (unpivot, coalesce chains, pivots, joins) is DataFrame work.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The standard market features and default cells.
STANDARD_FEATURES = ("Open", "High", "Low", "Close", "Volume", "Adj Close")
DEFAULT_PRICE = 100.0
DEFAULT_VOLUME = 1_000_000.0
SEP = "__"
_NUM = re.compile(r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$")


# ---------------------------------------------------------------- A1 / A2
def _cells(line: str) -> list[str]:
    return [c.strip() for c in line.split(",")]


def read_ohlcv(spark: SparkSession, path: str, layout: str = "auto") -> DataFrame:
    """Read a market CSV.  Two header rows (feature, ticker) are used when
    the first line repeats feature names or the second line is non-numeric;
    a third row that only names the index (``Date,,,``) is a header as well.
    Wide columns are named ``Feature__TICKER``; the first column is the date.
    A row whose date is empty or no date is kept with a NULL date."""
    lines = [_cells(r.value) for r in spark.read.text(path).limit(3).collect()]
    lines += [[]] * (3 - len(lines))
    first, second, third = lines
    # A two-level (feature, ticker) header repeats each feature name; failing
    # that, a non-numeric second line is a header too.
    repeated = len(set(first[1:])) < len(first[1:])
    two_rows = layout == "wide" or (layout == "auto" and bool(second) and (
        repeated or not any(_NUM.match(c) for c in second[1:] if c)))
    if first and first[0].startswith("Unnamed"):
        raise ValueError("level-0 header starts with 'Unnamed'")
    heads = [first, second] if two_rows else [first]
    if two_rows and third and third[0] and not third[0][0].isdigit() and not any(third[1:]):
        heads.append(third)
    raw = spark.read.option("header", False).option("inferSchema", False).csv(path)
    names = ["date"] + ([f"{a}{SEP}{b}" for a, b in zip(first[1:], second[1:])] if two_rows
                        else first[1:])
    df = raw.toDF(*names)
    # Header rows are recognised by all their cells.
    row = F.concat_ws(",", *[F.coalesce(F.trim(F.col(f"`{c}`")), F.lit("")) for c in names])
    df = df.filter(~row.isin(*[",".join(h) for h in heads]))
    out = [F.col("date").try_cast("date").alias("date")]
    out += [F.col(f"`{c}`").try_cast("double").alias(c) for c in names[1:]]
    return df.select(*out)


def _flat_parts(name: str) -> tuple[str, str] | None:
    """(feature, ticker) of a column ``{ticker}_{feature}``."""
    ticker, _, feature = name.rpartition("_")
    known = {f.lower(): f for f in STANDARD_FEATURES} | {"adj_close": "Adj Close", "vol": "Vol"}
    if ticker.lower().endswith("_adj") and feature.lower() == "close":
        ticker, feature = ticker[:-4], "adj_close"
    return (known[feature.lower()], ticker) if ticker and feature.lower() in known else None


def detect_layout(df: DataFrame) -> dict:
    """wide / flat / long / single from column names.  ``tickers`` is a list
    where names tell it; for a long frame it is a one-column DataFrame."""
    cols = df.columns
    wide = [tuple(c.split(SEP)[:2]) for c in cols if SEP in c]
    flat = [] if wide else [p for p in map(_flat_parts, cols) if p]
    if wide or flat:
        return {"layout": "wide" if wide else "flat", "features": sorted({f for f, _ in wide or flat}),
                "tickers": sorted({t for _, t in wide or flat}), "detected": True}
    low = {c.lower() for c in cols}
    feats = [f for f in STANDARD_FEATURES if f.lower() in low]
    if "ticker" in low:
        return {"layout": "long", "features": feats, "tickers": df.select("ticker").distinct(), "detected": True}
    return {"layout": "single", "features": feats, "tickers": ["SINGLE_TICKER"],
            "detected": bool(feats)}


# ---------------------------------------------------------------- A3
def _pick(cols: set, *names):
    for n in names:
        if n in cols:
            return F.col(f"`{n}`")
    return None


def to_bars(df: DataFrame, tickers: list[str] | None = None) -> DataFrame:
    """Long ``bars(ticker, date, open, high, low, close, volume)`` from any
    layout, with the column fallbacks: Vol → Volume; Adj Close → Close;
    missing O/H/L → Close, else 100; missing Volume → 1e6.  Defaults apply to
    missing COLUMNS and absent tickers only; NULL cells stay NULL (B1 handles
    them).  Columns that match no layout raise."""
    info = detect_layout(df)
    if not info["detected"]:
        raise ValueError(f"no market layout in columns {df.columns}")
    if info["layout"] in ("wide", "flat"):
        # One struct per ticker and one explode: no shuffle, no row merged.
        parts = {c: tuple(c.split(SEP)[:2]) if SEP in c else _flat_parts(c) for c in df.columns if c != "date"}
        at = {p: c for c, p in parts.items() if p}
        rows = [F.struct(F.lit(t).alias("ticker"), *[
            (F.col(f"`{at[f, t]}`") if (f, t) in at else F.lit(None)).cast("double").alias(f)
            for f in info["features"]]) for t in info["tickers"]]
        base = df.select("date", F.explode(F.array(*rows)).alias("_s")).select("date", "_s.*")
    elif info["layout"] == "long":
        base = df.select(*[F.col(c).alias(c) for c in df.columns])
        for c in list(base.columns):
            if c.lower() in {f.lower() for f in STANDARD_FEATURES} | {"vol", "ticker", "date"}:
                std = {f.lower(): f for f in STANDARD_FEATURES}.get(c.lower(), c.lower())
                if std != c:
                    base = base.withColumnRenamed(c, std)
    else:
        base = df.withColumn("ticker", F.lit("SINGLE_TICKER"))
    cols = set(base.columns)
    close = _pick(cols, "Close", "Adj Close")
    close = close if close is not None else F.lit(DEFAULT_PRICE)

    def price(n):
        c = _pick(cols, n)
        return c if c is not None else close

    vol = _pick(cols, "Volume", "Vol", "vol")
    vol = vol if vol is not None else F.lit(DEFAULT_VOLUME)
    bars = base.select(F.col("ticker").cast("string").alias("ticker"), "date",
                       price("Open").cast("double").alias("open"),
                       price("High").cast("double").alias("high"),
                       price("Low").cast("double").alias("low"),
                       close.cast("double").alias("close"), vol.cast("double").alias("volume"))
    if tickers:
        # Absent tickers get the default levels 100 + 10·i (i = feature
        # index) and volume 1e6 on every date of the calendar.
        want = [str(t) for t in tickers]
        bars = bars.filter(F.col("ticker").isin(*want))
        fill = bars.select("date").distinct().select(
            F.explode(F.array(*[F.lit(t) for t in want])).alias("ticker"), "date")
        fill = fill.join(bars.select("ticker").distinct(), "ticker", "left_anti")
        bars = bars.unionByName(fill.select(
            "ticker", "date", *[F.lit(DEFAULT_PRICE + 10.0 * i).alias(c)
                                for i, c in enumerate(("open", "high", "low", "close"))],
            F.lit(DEFAULT_VOLUME).alias("volume")))
    return bars


# ---------------------------------------------------------------- A4 / A5
def normalize_tickers(df: DataFrame, col: str = "ticker", required: bool = False) -> DataFrame:
    """trim + upper; blank or NULL symbols dropped; no dedupe.  Nothing left is an
    empty frame, or with ``required`` an error when the frame is read: the check
    is one counted row of the same plan, no job of its own."""
    t = F.upper(F.trim(F.col(col).cast("string")))
    good = F.col(col).isNotNull() & (F.length(col) > 0)
    kept = df.withColumn(col, t).filter(good)
    if not required:
        return kept
    none = F.raise_error(F.lit(f"no usable {col} is left")).cast("boolean")
    check = df.select(t.alias(col)).agg(F.count_if(good).alias("_n")).filter(F.when(F.col("_n") == 0, none).otherwise(F.lit(False)))
    return kept.unionByName(check.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kept.schema.fields]))


def date_range(df: DataFrame, start=None, end=None, col: str = "date") -> DataFrame:
    """Inclusive bounds (pushed into the Parquet scan)."""
    c = F.col(col)
    if start is not None:
        df = df.filter(c >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(c <= F.lit(end).cast("date"))
    return df


def lookback(df: DataFrame, end, years: float, col: str = "date") -> DataFrame:
    """start = end − 365·years days."""
    days = int(365 * years)
    return df.filter(F.col(col).between(F.date_sub(F.lit(end).cast("date"), days),
                                        F.lit(end).cast("date")))


def merge_snapshots(snaps: DataFrame, keys=("ticker", "date"), version: str = "snapshot_date") -> DataFrame:
    """Overlapping snapshots: newest snapshot wins per (ticker, date) — an
    aggregate (``max_by``), so a hot key is combined map-side."""
    rest = [c for c in snaps.columns if c not in keys]
    return snaps.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(version)).alias("_r")).select(*keys, "_r.*")


# ---------------------------------------------------------------- A7 / A8
def dataset_inventory(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per file: rows, size in MB and modification time from the scan's
    hidden ``_metadata`` column (no driver-side listing of data)."""
    df = spark.read.parquet(*paths).select("_metadata.file_path", "_metadata.file_size",
                                           "_metadata.file_modification_time")
    return df.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n_rows"), (F.first("file_size") / (1024 * 1024)).alias("size_mb"),
        F.first("file_modification_time").alias("modified"))


def latest_snapshot(df: DataFrame, col: str = "snapshot_date") -> DataFrame:
    """The newest snapshot partition (partition pruning keeps the scan to it)."""
    newest = df.agg(F.max(col).alias(col))
    return df.join(newest, col, "left_semi")


def read_latest_snapshot(spark: SparkSession, path: str, prefix: str = "snapshot_date=") -> DataFrame:
    """A7 by name: the newest partition folder of a snapshot table, found from
    folder names alone, so no data of older ones is read.  No folder raises."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()] if files.exists(folder) else []
    names = sorted(n for n in names if n.startswith(prefix))
    if not names:
        raise FileNotFoundError(f"{path} holds no folder {prefix}…")
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/{names[-1]}")


def write_snapshot(df: DataFrame, path: str, snapshot: str, metadata: dict | None = None,
                   catalog_path: str | None = None, ticker: str = "ticker", date: str = "date") -> None:
    """Write a snapshot partition and append its metadata row to a catalog
    table: rows, columns with types, number of tickers and date range (NULL
    where the frame has no such column), creation time, user metadata.  The
    facts are counted on the written files, not on a second run of ``df``."""
    df.withColumn("snapshot_date", F.lit(snapshot)).write.mode("append") \
        .partitionBy("snapshot_date").parquet(path)
    if catalog_path:
        written = df.sparkSession.read.schema(df.schema).parquet(f"{path.rstrip('/')}/snapshot_date={snapshot}")
        low = F.min(date) if date in df.columns else F.lit(None)
        high = F.max(date) if date in df.columns else F.lit(None)
        n_tickers = F.countDistinct(ticker) if ticker in df.columns else F.lit(None).cast("long")
        written.agg(F.count(F.lit(1)).alias("n_rows"), n_tickers.alias("n_tickers"),
                    low.cast("string").alias("first_date"), high.cast("string").alias("last_date")).select(
            F.lit(path).alias("path"), F.lit(snapshot).alias("snapshot_date"),
            F.lit(json.dumps(metadata or {}, sort_keys=True)).alias("metadata"),
            F.lit(len(df.columns)).alias("n_cols"), F.lit(json.dumps(dict(df.dtypes))).alias("dtypes"),
            "n_rows", "n_tickers", "first_date", "last_date",
            F.current_timestamp().alias("created_at")).write.mode("append").parquet(catalog_path)
