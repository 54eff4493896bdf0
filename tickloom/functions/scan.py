"""EMA, MACD and RSI at tick grain: an associative scan of affine maps.

A first-order recurrence over one series is sequential, and a series at tick grain
may hold a third of all rows.  But a block of consecutive rows acts on the state
that enters it as an affine map (scale times state plus shift), and affine maps
compose.  So:
  1. rows are range-partitioned by (key, order) into blocks of a bounded number of
     rows, so that a hot key is as many blocks as its share, and written once;
  2. one row per (key, block) tells how many rows came before and the last price;
  3. each block is solved by itself with state zero: every row carries its shift
     and its scales towards the unknown entering state;
  4. the blocks' maps are composed along each key, over one row per block;
  5. the entering states are joined back and every row's value is
     shift + scale * state, in the JVM.

Results equal the sequential definitions of ``recurrence.ema_frame`` on each
key's rows in order.  Rows without a price, key or time take no part in the
recurrence and get NULL indicators.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.core import UNB
from tickloom.functions.recurrence import EMA_COLS

#: Rows of a block on average; a Python worker holds one block at a time.
BLOCK_ROWS = 1 << 16

STATES = ("ema", "fast", "slow", "sig", "up", "down")


def _smooth(x: np.ndarray, alpha: float, seeded: bool) -> np.ndarray:
    """y_i = (1 - alpha) y_(i-1) + alpha x_i from y_(-1) = 0, or from y_0 = x_0."""
    values = x if seeded else np.concatenate([[0.0], x])
    y = pd.Series(values).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    return y if seeded else y[1:]


def block_maps(price: np.ndarray, before: int, previous: float | None, window: int, fast: int, slow: int,
               signal: int) -> dict[str, np.ndarray]:
    """Shift of every state at every row of a block, and its scales: ``scale_x``
    towards the entering state x itself, ``sig_fast`` and ``sig_slow`` towards the
    two price averages the signal line smooths.  ``before`` rows precede the block."""
    n = len(price)
    i = np.arange(n)
    seeded = before == 0
    spans = {"ema": 2 / (window + 1), "fast": 2 / (fast + 1), "slow": 2 / (slow + 1), "up": 1 / window, "down": 1 / window}
    change = np.diff(price, prepend=price[0] if previous is None else previous)
    rows = {"ema": price, "fast": price, "slow": price, "up": np.maximum(change, 0.0), "down": np.maximum(-change, 0.0)}
    out = {}
    for name, alpha in spans.items():
        out[name] = _smooth(rows[name], alpha, seeded)
        out[f"scale_{name}"] = np.zeros(n) if seeded else (1 - alpha) ** (i + 1.0)
    # The signal line starts at the first MACD, row slow - 1 of the series.
    a = 2 / (signal + 1)
    start = slow - 1 - before
    parts = {"sig": out["fast"] - out["slow"], "sig_fast": out["scale_fast"], "sig_slow": -out["scale_slow"]}
    at = max(start, 0)
    for name, x in parts.items():
        y = np.zeros(n)
        if at < n:
            y[at:] = _smooth(x[at:], a, start >= 0)
        out[name] = y
    out["scale_sig"] = np.where(i >= at, (1 - a) ** (i - at + 1.0), 1.0) if start < 0 else np.zeros(n)
    return out


MAPS = [*STATES, *(f"scale_{s}" for s in STATES), "sig_fast", "sig_slow"]


def tick_indicators(ticks: DataFrame, key: str = "ticker", order=("ts", "seq"), price: str = "price",
                    window: int = 14, fast: int = 12, slow: int = 26, signal: int = 9,
                    blocks: int | None = None) -> DataFrame:
    """F2–F6 on ticks: ``ticks`` plus EMA, MACD, MACD_Signal, MACD_Diff and RSI
    per ``key`` series in ``order`` (which must be unique inside a key).
    ``blocks`` is the number of range partitions (by default one for every
    ``BLOCK_ROWS`` rows)."""
    from tickloom.session import materialize
    order = list(order)
    complete = F.col(key).isNotNull() & F.col(price).isNotNull() & F.col(order[0]).isNotNull()
    known, rest = ticks.filter(complete), ticks.filter(~F.coalesce(complete, F.lit(False)))
    bounds = [F.col(key), *[F.col(c) for c in order]]
    blocks = blocks or max(ticks.sparkSession.sparkContext.defaultParallelism, -(-known.count() // BLOCK_ROWS))
    base = materialize(known.repartitionByRange(blocks, *bounds).withColumn("_pid", F.spark_partition_id()), "tick_blocks")
    place = F.struct(*order)
    ends = base.groupBy(key, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.max_by(price, place).alias("_last"))
    along = Window.partitionBy(key).orderBy("_pid")
    ends = ends.select(key, "_pid", F.coalesce(F.sum("_n").over(along.rowsBetween(UNB, -1)), F.lit(0)).alias("_before"),
                       F.lag("_last").over(along).cast("double").alias("_previous"))
    schema = T.StructType([*base.schema.fields, T.StructField("_i", T.LongType()),
                           *[T.StructField(f"_{c}", T.DoubleType()) for c in MAPS]])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[pdf["_rank"].argsort(kind="stable")] if "_rank" in pdf else pdf
        before = int(pdf["_before"].iloc[0])
        previous = None if before == 0 else float(pdf["_previous"].iloc[0])
        maps = block_maps(pdf[price].to_numpy(np.float64), before, previous, window, fast, slow, signal)
        out = pdf.drop(columns=["_before", "_previous", "_rank"]).reset_index(drop=True)
        return out.assign(_i=np.arange(before, before + len(out)), **{f"_{c}": maps[c] for c in MAPS})

    in_block = Window.partitionBy(key, "_pid").orderBy(*order)
    with_before = base.join(ends, [key, "_pid"]).withColumn("_rank", F.row_number().over(in_block))
    # pandas need not order structs: the JVM has numbered the rows of a block.
    solved = materialize(with_before.select(*base.columns, "_before", "_previous", "_rank")
                         .groupBy(key, "_pid").applyInPandas(solve, schema), "tick_maps")
    last = solved.groupBy(key, "_pid").agg(F.max_by(F.struct(*[f"_{c}" for c in MAPS]), "_i").alias("_m")).select(
        key, "_pid", "_m.*")

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pid").reset_index(drop=True)
        state = dict.fromkeys(STATES, 0.0)
        rows = []
        for r in pdf.to_dict("records"):
            rows.append(dict(state))
            entering = state
            state = {s: r[f"_{s}"] + r[f"_scale_{s}"] * entering[s] for s in STATES}
            state["sig"] += r["_sig_fast"] * entering["fast"] + r["_sig_slow"] * entering["slow"]
        found = pd.DataFrame(rows, columns=list(STATES)).add_prefix("_in_")
        return pd.concat([pdf[[key, "_pid"]], found], axis=1)

    state_schema = T.StructType([base.schema[key], base.schema["_pid"],
                                 *[T.StructField(f"_in_{s}", T.DoubleType()) for s in STATES]])
    entering = last.groupBy(key).applyInPandas(compose, state_schema)
    rows = solved.join(entering, [key, "_pid"])
    value = {s: F.col(f"_{s}") + F.col(f"_scale_{s}") * F.col(f"_in_{s}") for s in STATES}
    value["sig"] = value["sig"] + F.col("_sig_fast") * F.col("_in_fast") + F.col("_sig_slow") * F.col("_in_slow")
    i = F.col("_i")
    macd = F.when(i >= slow - 1, value["fast"] - value["slow"])
    line = F.when(i >= slow + signal - 2, value["sig"])
    strength = F.when(value["down"] == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.try_divide(value["up"], value["down"])))
    found = dict(zip(EMA_COLS, (F.when(i >= window - 1, value["ema"]), macd, line, macd - line,
                                F.when(i >= window - 1, strength))))
    out = rows.select(*ticks.columns, *[e.alias(c) for c, e in found.items()])
    return out.unionByName(rest.select("*", *[F.lit(None).cast("double").alias(c) for c in EMA_COLS]))
