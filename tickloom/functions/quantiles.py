"""Exact quantiles without funnelling a column into one task.

``percentile`` (exact) merges every distinct value of a group into one
buffer; for a global ``describe`` that is the whole column in one task.
Here a mergeable sketch names, for every quantile, two values that enclose it; one
pass counts exactly how many values lie below and between them, and only those
between, a small share of the column, are ordered.  A quantile that its two values
should not enclose is looked for among all values.

The values between are counted first (map-side), so a value that fills a third
of a column is one row.  The distinct values are range-partitioned and written
with their partition number; per-partition counts (one row per partition and
key) tell which partitions hold the needed ranks, and only those are read again
and ordered.  Linear interpolation between ranks ⌊q(n−1)⌋ and ⌈q(n−1)⌉ (pandas).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A value of the sketch is at most 1 / ACCURACY of the rows from its rank.
ACCURACY = 10_000


def enclosed(known: DataFrame, qs, key: str, value: str, accuracy: int = ACCURACY) -> DataFrame:
    """(key, _i, q, _h, _low, _high, _below): the rank of each quantile, two values
    between which it lies and the number of values below the first; NULL values
    and no rows below where the two do not enclose it."""
    from tickloom.session import materialize
    probes = [min(max(q + side * 4 / accuracy, 0.0), 1.0) for q in qs for side in (-1, 1)]
    marks = materialize(known.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                               F.percentile_approx(value, probes, accuracy).alias("_p")), "quantile_marks")
    v = F.col(value)
    counts = []
    for i in range(len(qs)):
        low, high = F.col("_p")[2 * i], F.col("_p")[2 * i + 1]
        counts += [F.count(F.when(v < low, 1)).alias(f"_b{i}"), F.count(F.when((v >= low) & (v <= high), 1)).alias(f"_m{i}")]
    told = marks.join(known.join(marks, key).groupBy(key).agg(*counts), key)
    rows = []
    for i, q in enumerate(qs):
        h, below = F.lit(float(q)) * (F.col("_n") - 1), F.col(f"_b{i}")
        ok = (F.floor(h) >= below) & (F.ceil(h) < below + F.col(f"_m{i}"))
        rows.append(F.struct(F.lit(i).alias("_i"), F.lit(float(q)).alias("q"), h.alias("_h"),
                             F.when(ok, F.col("_p")[2 * i]).alias("_low"), F.when(ok, F.col("_p")[2 * i + 1]).alias("_high"),
                             F.when(ok, below).otherwise(F.lit(0)).alias("_below")))
    return materialize(told.select(key, F.explode(F.array(*rows)).alias("_s")).select(key, "_s.*"), "quantile_limits")


def exact_quantiles(long: DataFrame, qs=(0.25, 0.5, 0.75), key: str = "column",
                    value: str = "value") -> DataFrame:
    """(key, q, quantile) for each group of a long (key, value) table.  NULL
    values and NULL keys take no part; a group without values has no row."""
    from tickloom.session import materialize
    known = long.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    limits = enclosed(known, list(dict.fromkeys(qs)), key, value)
    one = [key, "_i"]
    among = F.col("_low").isNull() | ((F.col(value) >= F.col("_low")) & (F.col(value) <= F.col("_high")))
    near = known.join(limits.select(*one, "_low", "_high"), key).filter(among)
    # Written once: the counts and the rows must see the same partitions,
    # which two executions of a sampled range exchange do not promise.
    counted = materialize(near.groupBy(*one, value).agg(F.count(F.lit(1)).alias("_c"))
                          .repartitionByRange(*one, value)
                          .withColumn("_pid", F.spark_partition_id()), "value_counts")
    per = counted.groupBy(*one, "_pid").agg(F.sum("_c").alias("_c"))
    w = Window.partitionBy(*one).orderBy("_pid")
    parts = per.select(*one, "_pid", (F.sum("_c").over(w) - F.col("_c")).alias("_from"),
                       F.sum("_c").over(w).alias("_to"))
    pts = limits.select(*one, "q", "_h", "_below", F.explode(F.array_distinct(F.array(
        F.floor("_h").cast("long"), F.ceil("_h").cast("long")))).alias("_rank"))
    pts = pts.withColumn("_at", F.col("_rank") - F.col("_below")).join(parts, one)
    pts = pts.filter((F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to")))
    held = counted.join(pts.select(*one, "_pid", "_from").distinct(), [*one, "_pid"])
    upto = F.sum("_c").over(Window.partitionBy(*one, "_pid").orderBy(value)) + F.col("_from")
    spans = held.select(*one, "_pid", value, (upto - F.col("_c")).alias("_lo"), upto.alias("_hi"))
    hit = pts.join(spans, [*one, "_pid"]).filter(
        (F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi")))
    g = hit.groupBy(*one, "q", "_h").agg(F.min_by(value, "_rank").alias("_vlo"),
                                         F.max_by(value, "_rank").alias("_vhi"),
                                         F.min("_rank").alias("_rlo"))
    frac = F.col("_h") - F.col("_rlo")
    return g.select(key, "q", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * frac).alias("quantile"))
