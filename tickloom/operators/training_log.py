"""L1–L5 — training-log analytics (the log is data; training is not built).

A log is ``(run_id, ts, event_id, reward, …)``; the step number is the row's
position in its run ordered by (ts, event_id).  Check-step statistics are
trailing-frame aggregates; "best so far" and "checks since last improvement"
are running frames and islands over the check rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.core import UNB, td
from tickloom.functions.sequence import sequence_number


def with_steps(log: DataFrame, key: str = "run_id") -> DataFrame:
    """step = position in the run by (ts, event_id), numbered inside (run, hour)
    and offset by the run's earlier hours (a hot run is spread over many tasks).
    A log that brings its own ``step`` stays as it is."""
    if "step" in log.columns:
        return log
    return sequence_number(log, [key], ["ts", "event_id"], F.date_trunc("hour", "ts"), name="step")


def training_progress(log: DataFrame, every: int = 1000, n: int = 100,
                      key: str = "run_id") -> DataFrame:
    """L1: at each check step (step % every == 0) once more than ``n`` rows
    exist: mean / population std of the last ``n`` rewards and the last one, and
    for a log with ``ret``, ``drawdown`` or ``value`` their means (in percent but
    for the value) and the std of the returns.

    Each row is routed to the check step(s) whose trailing n rows contain it
    (at most ⌈n/every⌉ of them), and every check is one ``groupBy`` group —
    partial aggregation, no window over a whole run."""
    df = with_steps(log, key)
    k = (n + every - 1) // every
    first = F.ceil(F.col("step") / every) * every
    checks = F.array(*[first + j * every for j in range(k)])
    extra = [c for c in ("ret", "drawdown", "value") if c in df.columns]
    more = {"ret": [F.avg(F.col("ret") * 100).alias("mean_ret_pct"), F.stddev_pop(F.col("ret") * 100).alias("std_ret_pct")],
            "drawdown": [F.avg(F.col("drawdown") * 100).alias("mean_drawdown_pct")],
            "value": [F.avg("value").alias("mean_value")]}
    routed = df.select(key, "step", "reward", *extra, F.explode(checks).alias("check"))
    routed = routed.filter((F.col("check") - F.col("step") < n) & (F.col("check") > n))
    g = routed.groupBy(key, F.col("check").cast("long").alias("step")).agg(
        F.avg("reward").alias("mean_reward"), F.stddev_pop("reward").alias("std_reward"),
        F.max_by("reward", "step").alias("last_reward"), *[a for c in extra for a in more[c]],
        F.max("step").alias("_last"))
    # A check exists only if the run reached that step.
    return g.filter(F.col("_last") == F.col("step")).drop("_last")


def _improvements(progress: DataFrame, key: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy("step")
    best_before = F.max("mean_reward").over(w.rowsBetween(UNB, -1))
    improved = F.coalesce(F.col("mean_reward") > best_before, F.col("mean_reward").isNotNull()
                          & ~F.isnan("mean_reward"))
    return progress.withColumn("improved", improved)


def best_checkpoints(progress: DataFrame, key: str = "run_id") -> DataFrame:
    """L2: check steps where the mean reward beats every earlier check (strict)."""
    return _improvements(progress, key).filter("improved") \
        .select(key, "step", "mean_reward")


def early_stop(log: DataFrame, progress: DataFrame, patience: int = 5, min_step: int = 10000,
               key: str = "run_id") -> DataFrame:
    """L3: first step where a run stops — ``patience`` consecutive checks
    without improvement after ``min_step``, or a NaN reward at any step."""
    p = _improvements(progress, key)
    w = Window.partitionBy(key).orderBy("step")
    grp = F.sum(F.when(F.col("improved"), 1).otherwise(0)).over(w.rowsBetween(UNB, 0))
    p = p.withColumn("_grp", grp)
    since = F.sum(F.when(F.col("improved"), 0).otherwise(1)).over(
        Window.partitionBy(key, "_grp").orderBy("step").rowsBetween(UNB, 0))
    p = p.withColumn("no_improvement", since)
    by_patience = p.filter((F.col("no_improvement") >= patience) & (F.col("step") > min_step)) \
        .groupBy(key).agg(F.min("step").alias("step")).withColumn("reason", F.lit("no improvement"))
    nan = with_steps(log, key).filter(F.isnan("reward") | F.col("reward").isNull()) \
        .groupBy(key).agg(F.min("step").alias("step")).withColumn("reason", F.lit("nan reward"))
    both = by_patience.unionByName(nan)
    return both.groupBy(key).agg(F.min_by("reason", "step").alias("reason"),
                                 F.min("step").alias("stop_step"))


def training_summary(log: DataFrame, progress: DataFrame, key: str = "run_id") -> DataFrame:
    """L4: steps, first / final / best reward, total reward and the best check
    mean; for a log with ``value`` also first and final value and total return."""
    order = F.col("step") if "step" in log.columns else F.struct(F.col("ts"), F.col("event_id"))
    valued = "value" in log.columns
    values = [F.min_by("value", order).alias("first_value"), F.max_by("value", order).alias("final_value"),
              F.max("reward").alias("best_reward")] if valued else []
    s = log.groupBy(key).agg(F.count(F.lit(1)).alias("n_steps"),
                             F.min_by("reward", order).alias("first_reward"),
                             F.max_by("reward", order).alias("final_reward"),
                             F.sum("reward").alias("total_reward"), *values)
    if valued:
        s = s.withColumn("total_return", (td("final_value", "first_value") - 1) * 100)
    best = progress.groupBy(key).agg(F.max("mean_reward").alias("best_mean_reward"))
    return s.join(best, key, "left")


def failure_ratio(log: DataFrame, width: str = "30 minutes", threshold: float = 0.2,
                  failed=None, slide: str | None = None) -> DataFrame:
    """Failed ÷ all runs per time window; ``alert`` when above 0.2.
    ``failed`` defaults to error events.  With ``slide`` (a divisor of ``width``)
    the trailing window is evaluated at every slide, from one row per slide."""
    if failed is None:
        failed = F.col("event_type") == "error"
    runs = [F.count(F.lit(1)).alias("runs"), F.sum(F.when(failed, 1).otherwise(0)).cast("long").alias("failed")]
    if slide is None:
        g = log.groupBy(F.window("ts", width).alias("w")).agg(*runs)
    else:
        per = log.groupBy(F.window("ts", slide).alias("_m")).agg(*runs).select(
            F.col("_m.start").alias("ts"), "runs", "failed")
        g = per.groupBy(F.window("ts", width, slide).alias("w")).agg(
            F.sum("runs").alias("runs"), F.sum("failed").alias("failed"))
    return g.select(F.col("w.start").alias("window_start"), "runs", "failed",
                    (F.col("failed") / F.col("runs")).alias("failure_ratio"),
                    ((F.col("failed") / F.col("runs")) > threshold).alias("alert"))
