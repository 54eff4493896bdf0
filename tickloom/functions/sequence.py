"""Position of each row inside its key, without a window over a whole key.

``Window.partitionBy(key).orderBy(...)`` sends a whole key to one task.  Here
rows are numbered in two levels: inside (key, bucket), where ``bucket`` is a
coarser form of the order (the hour of a timestamp), and the number of rows of
the key's earlier buckets is added, from a table with one row per key and bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sequence_number(df: DataFrame, keys, order, bucket: Column, name: str = "seq") -> DataFrame:
    """Add ``name`` = 1-based position of the row in its ``keys`` group ordered
    by ``order`` (a unique tiebreak must be part of it).  ``bucket`` must not
    fall along that order.  NULL keys form a group; NULL order values come first."""
    keys = list(keys)
    rows = df.withColumn("_b", bucket)
    per = rows.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_kb"),
                         F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_off"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    same.append(F.col("_b").eqNullSafe(F.col("_kb")))
    inside = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order))
    numbered = rows.withColumn("_in", inside).join(offsets, reduce(Column.__and__, same))
    return numbered.withColumn(name, F.col("_off") + F.col("_in")).drop(
        "_b", "_in", "_off", "_kb", *[f"_k{i}" for i in range(len(keys))])
