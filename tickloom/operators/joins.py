"""D1–D8 — joins.

D1 is the only join Spark lacks (a backward as-of join).  It is built from a
look-up of *times*: the distinct (key, time) points of both sides are dealt into
time buckets, each left time learns the last right time at or before it, and the
fact table is then equi-joined twice — on its time to get the right-side time,
and on that time to get the right row.

The look-up is a two-level scan, so no task holds a whole key or all times: a
window inside (key, bucket) finds a right time of the same bucket, and the last
right time of the buckets before comes from a table with one row per key and
bucket.  "Last" is a running maximum, so that table is scanned in two levels as
well: inside groups of buckets, and over one row per group.  A key that holds a
third of all rows is split over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.core import UNB

DATE_WIDTH, TIME_WIDTH = 32 * 86400, 3600  # seconds of a bucket of dates, of times
GROUP = 1024                               # buckets of a group


def _earlier_max(table: DataFrame, keys: list[str], order: str, value: Column, name: str) -> DataFrame:
    """``value``'s maximum over the rows before, per ``keys``.  Without keys the
    table (one row per group of buckets, bounded by the time span) is scanned as
    one array."""
    if keys:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(UNB, -1)
        return table.select(*keys, order, F.max(value).over(before).alias(name))
    rows = table.agg(F.sort_array(F.collect_list(F.struct(F.col(order), value.alias("_m")))).alias("_a"))
    seen = F.transform("_a", lambda x, i: F.struct(
        x[order].alias(order), F.array_max(F.slice(F.col("_a"), 1, i)["_m"]).alias(name)))
    return rows.select(F.explode(seen).alias("_x")).select("_x.*")


def asof_calendar(left_times: DataFrame, right_times: DataFrame, on: str = "date", by: str | None = None,
                  width_seconds: int | None = None, group: int = GROUP) -> DataFrame:
    """([by,] on, _asof): for every distinct left time the greatest right time
    <= it, of the same key.  NULL times and keys match nothing."""
    keys = [by] if by else []
    if width_seconds is None:
        width_seconds = DATE_WIDTH if left_times.schema[on].dataType.typeName() == "date" else TIME_WIDTH
    sides = left_times.select(*keys, on, F.lit(False).alias("_right")).unionByName(
        right_times.select(*keys, on, F.lit(True).alias("_right")))
    for c in [*keys, on]:
        sides = sides.filter(F.col(c).isNotNull())
    points = sides.groupBy(*keys, on).agg(F.max("_right").alias("_right"), F.min("_right").alias("_only_right"))
    points = points.withColumn("_b", F.floor(F.unix_timestamp(on) / width_seconds))
    inside = Window.partitionBy(*keys, "_b").orderBy(on).rowsBetween(UNB, 0)
    right_time = F.when(F.col("_right"), F.col(on))
    found = points.select(*keys, on, "_b", "_only_right", F.max(right_time).over(inside).alias("_here"))
    per = points.groupBy(*keys, "_b").agg(F.max(right_time).alias("_last")).withColumn("_g", F.floor(F.col("_b") / group))
    groups = per.groupBy(*keys, "_g").agg(F.max("_last").alias("_last"))
    far = _earlier_max(groups, keys, "_g", F.col("_last"), "_far")
    in_group = Window.partitionBy(*keys, "_g").orderBy("_b").rowsBetween(UNB, -1)
    near = per.select(*keys, "_b", "_g", F.max("_last").over(in_group).alias("_near"))
    carry = near.join(far, [*keys, "_g"], "left").select(*keys, "_b", F.coalesce("_near", "_far").alias("_carry"))
    return found.filter(~F.col("_only_right")).join(carry, [*keys, "_b"], "left").select(
        *keys, on, F.coalesce("_here", "_carry").alias("_asof"))


def asof_join(left: DataFrame, right: DataFrame, on: str = "date", by: str | None = None,
              suffix: str = "_r", tiebreak=(), width_seconds: int | None = None, group: int = GROUP) -> DataFrame:
    """Backward as-of join: each left row gets the right row with the greatest
    ``on`` <= its own (``by`` optionally restricts matches to equal keys).
    Left-preserving; a NULL in the matched right row stays NULL.  Right
    columns other than the keys are renamed with ``suffix`` on collision.  Of
    right rows with one key and time the last by ``tiebreak`` counts; without a
    tiebreak times must be unique on the right.  ``width_seconds`` is the span of a
    bucket: choose it so that one key's distinct times in it fit a task."""
    keys = [by] if by else []
    rcols = [c for c in right.columns if c not in (on, by)]
    if tiebreak:
        last = F.max_by(F.struct(*rcols), F.struct(*tiebreak))
        right = right.groupBy(*keys, on).agg(last.alias("_v")).select(*keys, on, "_v.*")
    ren = {c: (c + suffix if c in left.columns else c) for c in rcols}
    r = right.select(F.col(on).alias("_asof"), *keys, *[F.col(c).alias(ren[c]) for c in rcols])
    cal = asof_calendar(left, right, on, by, width_seconds, group)
    return left.join(cal, [*keys, on], "left").join(r, [*keys, "_asof"], "left").drop("_asof")


def pair_align(panel: DataFrame, partners: DataFrame, value: str = "close", key: str = "ticker",
               on: str = "date") -> DataFrame:
    """(ticker, other, date, x, y) on common dates for the pairs that
    ``partners(ticker, other)`` names; the output grows with that table, never
    with the square of the universe unless the caller lists all pairs
    (``all_pairs``).  Each unordered pair is computed once and mirrored."""
    wanted = partners.select("ticker", "other").distinct().filter(F.col("ticker") != F.col("other"))
    half = wanted.select(F.least("ticker", "other").alias("ticker"), F.greatest("ticker", "other").alias("other")).distinct()
    a = panel.select(F.col(key).alias("ticker"), F.col(on).alias(on), F.col(value).alias("x"))
    b = panel.select(F.col(key).alias("other"), F.col(on).alias(on), F.col(value).alias("y"))
    pairs = half.join(a, "ticker").join(b, ["other", on])
    both = mirror_pairs(pairs.select("ticker", "other", on, "x", "y"), swap=("x", "y"))
    return both.join(wanted, ["ticker", "other"], "left_semi")


def all_pairs(keys: DataFrame, key: str = "ticker") -> DataFrame:
    """(ticker, other) for every ordered pair of a small universe: a partner
    table that is quadratic by request."""
    one = keys.select(F.col(key).alias("ticker")).distinct()
    members = one.agg(F.collect_set("ticker").alias("_all"))
    return one.join(members).select("ticker", F.explode("_all").alias("other")).filter("ticker <> other")


def mirror_pairs(half: DataFrame, swap=()) -> DataFrame:
    """Add the (other, ticker) copy of every (ticker, other) row; ``swap``
    names two columns that exchange places in the copy."""
    cols = []
    for c in half.columns:
        if c == "ticker":
            cols.append(F.col("other").alias("ticker"))
        elif c == "other":
            cols.append(F.col("ticker").alias("other"))
        elif swap and c == swap[0]:
            cols.append(F.col(swap[1]).alias(c))
        elif swap and c == swap[1]:
            cols.append(F.col(swap[0]).alias(c))
        else:
            cols.append(F.col(c))
    return half.unionByName(half.select(*cols))


def common_dates(df: DataFrame, key: str = "ticker", on: str = "date") -> DataFrame:
    """D3: dates present for every key (count-distinct equals the universe size)."""
    n = df.select(key).distinct().agg(F.count(F.lit(1)).alias("_n"))
    per = df.groupBy(on).agg(F.countDistinct(key).alias("_k"))
    return per.join(n, F.col("_k") == F.col("_n")).select(on)


def missing_features(expected: DataFrame, available: DataFrame, col: str = "feature") -> DataFrame:
    """Expected names absent from the available set (anti-join)."""
    return expected.select(col).distinct().join(available.select(col), col, "left_anti")
