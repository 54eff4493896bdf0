"""E2 / E3 — statistics stored with every feature (``describe`` and array stats)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.quantiles import exact_quantiles

NUMERIC = ("double", "float", "long", "integer", "short", "byte", "decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in NUMERIC]


def _long(df: DataFrame, cols) -> DataFrame:
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                             for c in cols])).alias("_s")
    return df.select(st).select("_s.column", "_s.value")


def describe(df: DataFrame, cols=None) -> DataFrame:
    """Per numeric column count, mean, std (ddof 1), min, 25/50/75 %
    (exact, linear interpolation — pandas' definition) and max."""
    from tickloom.session import materialize
    cols = list(cols or numeric_columns(df))
    # The long table feeds a sampled range sort and an aggregate: write it
    # once instead of deriving it from the sources for each pass.
    long = materialize(_long(df, cols), "describe_long")
    basic = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = exact_quantiles(long, (0.25, 0.5, 0.75))
    wide = q.groupBy("column").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("quantile"))
    wide = wide.toDF("column", "p25", "p50", "p75")
    return basic.join(wide, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def array_stats(df: DataFrame, cols=None) -> DataFrame:
    """Shape, min, max, mean and population std over all numeric cells."""
    cols = list(cols or numeric_columns(df))
    long = _long(df, cols)
    return long.agg(
        F.count(F.lit(1)).alias("n_cells"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")).select(
        (F.col("n_cells") / len(cols)).cast("long").alias("n_rows"), F.lit(len(cols)).alias("n_cols"),
        "min", "max", "mean", "std")
