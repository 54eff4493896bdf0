"""G1–G9 — the portfolio back-test as a set-based operator.

The step simulator's recurrence has a closed form because the market move
and the turnover cost are both proportional to the previous value:

    V_s = V0 · Π_{t ≤ s} g_t,   g_t = Σ_i w_{t−1,i}·p_{t,i} − c·Σ_i |w_{t,i} − w_{t−1,i}|

so the back-test is one ``groupBy(portfolio, step)`` + a running
``product`` per portfolio.  Weights stay *sparse*: only assets with a
positive raw allocation are stored; a step without any is the equal-weight
fallback, handled analytically (Σ_i p_i / N for the market term and
closed-form turnover terms), so the work grows with the action rows, never
with portfolios × steps × assets.

A weight meets the one before it (same portfolio and asset, one step earlier) by a
window, and what it adds to its own step and to the next is two rows of the one
aggregate.  So everything after the actions is partitioned by portfolio: actions
that lie so already are not moved again.

Inputs
  prices   (ticker, step, close)           dense, repaired panel
  actions  (portfolio_id, step, ticker, raw) sparse raw allocations
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.core import UNB, td


@dataclass(frozen=True)
class BacktestParams:
    # The default environment configuration.
    window: int = 30
    initial_value: float = 10000.0
    cost: float = 0.0005
    return_rate: float = 0.0001
    risk_penalty: float = 0.1
    reward_scaling: float = 100.0
    reward_min: float = -5.0
    reward_max: float = 5.0
    stop_fraction: float = 0.1


def price_relatives(prices: DataFrame, clip=(0.1, 10.0)) -> DataFrame:
    """next/current close per (ticker, step); current ≤ 1e-8 → 1; the last
    step → 1; clipped to [0.1, 10]."""
    w = Window.partitionBy("ticker").orderBy("step")
    nxt = F.lead("close").over(w)
    c = F.col("close")
    rel = F.when(nxt.isNull(), F.lit(1.0)).when(c > 1e-8, nxt / c).otherwise(F.lit(1.0))
    rel = F.least(F.greatest(rel, F.lit(clip[0])), F.lit(clip[1]))
    return prices.select("ticker", "step", rel.alias("rel"))


def normalize_weights(actions: DataFrame, min_total: float = 1e-8) -> DataFrame:
    """G1 (sparse): per (portfolio, step) any NULL/NaN/inf → equal weights; negatives
    → 0; Σ > 1e-8 → raw/Σ, else equal.  Returns only the explicit (positive)
    weights; an absent (portfolio, step) means equal weights."""
    return weighed(actions, min_total).filter(F.col("weight").isNotNull())


def weighed(actions: DataFrame, min_total: float = 1e-8) -> DataFrame:
    """(portfolio_id, step, ticker, weight) of every action row; the weight is NULL
    where ``normalize_weights`` has no row."""
    g = Window.partitionBy("portfolio_id", "step")
    raw = F.col("raw")
    unusable = raw.isNull() | F.isnan(raw) | (F.abs(raw) == float("inf"))
    bad = F.max(F.when(unusable, 1).otherwise(0)).over(g)
    pos = F.when(unusable, F.lit(0.0)) \
        .otherwise(F.greatest(raw, F.lit(0.0)))
    total = F.sum(pos).over(g)
    df = actions.select("portfolio_id", "step", "ticker", pos.alias("pos"),
                        bad.alias("_bad"), total.alias("_tot"))
    explicit = (F.col("_bad") == 0) & (F.col("_tot") > min_total) & (F.col("pos") > 0)
    return df.select("portfolio_id", "step", "ticker", F.when(explicit, F.col("pos") / F.col("_tot")).alias("weight"))


def step_range(n_steps: int, window: int) -> tuple[int, int]:
    """Simulated steps: window … T−2, or the single step ``window`` when
    window ≥ T−1."""
    if window > n_steps:
        raise ValueError(f"window ({window}) > number of periods ({n_steps})")
    last = n_steps - 2 if window < n_steps - 1 else window
    return window, last


def _written(rel: DataFrame, name: str) -> DataFrame:
    """Price relatives, a row per asset and step, feed the mean of every step and
    the weights; written once, their size is known and small ones are broadcast."""
    from tickloom.session import materialize
    return materialize(rel, name)


def _neighbours(rows: DataFrame, value: str) -> DataFrame:
    """``before``: the asset's ``value`` one step earlier; ``stays``: it has a
    weight one step later.  A row without an asset has no neighbours."""
    w = Window.partitionBy("portfolio_id", "ticker").orderBy("step")
    asset, step = F.col("ticker").isNotNull(), F.col("step")
    return rows.select("*", F.when(asset & (F.lag("step").over(w) == step - 1), F.lag(value).over(w)).alias("before"),
                       F.coalesce(asset & (F.lead("step").over(w) == step + 1) & F.lead("weight").over(w).isNotNull(),
                                  F.lit(False)).alias("stays"))


def _per_step(rows: DataFrame, own: dict, later: dict, first: int, last: int) -> DataFrame:
    """One row per (portfolio, simulated step) with the sums of ``own``, which a
    weight adds to its step, and of ``later``, which it adds to the next step
    (columns by name; NULL adds nothing).  A portfolio without weights has its
    steps too; one without a name has no weights."""
    names = list(dict.fromkeys([*own, *later]))
    step = F.col("step").cast("long")

    def entry(at, terms):
        return F.struct(at.alias("step"), *[terms.get(c, F.lit(None)).cast("double").alias(c) for c in names])

    first_row = F.row_number().over(Window.partitionBy("portfolio_id").orderBy("ticker", "step")) == 1
    calendar = F.transform(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long")), lambda s: entry(s, {}))
    weighs = F.col("weight").isNotNull() & F.col("portfolio_id").isNotNull()
    told = F.when(weighs, F.array(entry(step, own), entry(step + 1, later)))
    nothing = F.array().cast(f"array<struct<step:bigint,{','.join(f'{c}:double' for c in names)}>>")
    entries = F.concat(F.coalesce(told, nothing), F.when(F.col("_first"), calendar).otherwise(nothing))
    out = rows.withColumn("_first", first_row).select("portfolio_id", F.explode(entries).alias("_e"))
    out = out.select("portfolio_id", "_e.*").filter(F.col("step").between(first, last))
    return out.groupBy("portfolio_id", "step").agg(*[F.sum(c).alias(c) for c in names])


def backtest(prices: DataFrame, actions: DataFrame, params: BacktestParams = BacktestParams(),
             n_steps: int | None = None, n_assets: int | None = None,
             materialize: bool = True) -> DataFrame:
    """G4 + G6 + G7: one row per (portfolio, step) with value, return, cost,
    volatility, running max, drawdown and reward; rows after the first step
    with V ≤ stop·V0 are dropped (the episode ended there)."""
    p = params
    if n_steps is None or n_assets is None:
        t, n = prices.agg(F.countDistinct("step"), F.countDistinct("ticker")).first()
        n_steps = t if n_steps is None else n_steps
        n_assets = n if n_assets is None else n_assets
    first, last = step_range(n_steps, p.window)
    inv_n = 1.0 / n_assets
    rel = price_relatives(prices).filter(F.col("step").between(first, last))
    rel = _written(rel, "backtest_relatives") if materialize else rel
    m_eq = rel.groupBy("step").agg(F.avg("rel").alias("m_eq"))

    # A weight counts from the first simulated step on; its asset's move is the next step's.
    w = weighed(actions).withColumn("weight", F.when(F.col("step").between(first, last), F.col("weight")))
    held = _neighbours(w, "weight")
    held = held.join(rel.select("ticker", (F.col("step") - 1).alias("step"), "rel"), ["ticker", "step"], "left")
    wc, before = F.col("weight"), F.coalesce(F.col("before"), F.lit(0.0))
    own = {"a": F.abs(wc - before), "bc": F.abs(wc - inv_n), "kc": F.lit(1.0)}
    # Market term of explicit previous weights: Σ w_{s−1,i}·rel_{s,i}.
    later = {"a": F.when(~F.col("stays"), wc), "bp": F.abs(wc - inv_n), "kp": F.lit(1.0), "m_sp": wc * F.col("rel")}
    g = _per_step(held, own, later, first, last).join(m_eq, "step", "left")
    kc, kp = F.coalesce(F.col("kc"), F.lit(0.0)), F.coalesce(F.col("kp"), F.lit(0.0))
    turnover = (F.when((kc > 0) & (kp > 0), F.col("a"))
                .when(kc > 0, F.col("bc") + (n_assets - kc) * inv_n)
                .when(kp > 0, F.col("bp") + (n_assets - kp) * inv_n)
                .otherwise(F.lit(0.0)))
    market = F.when(kp > 0, F.col("m_sp")).otherwise(F.col("m_eq"))
    g = g.select("portfolio_id", "step", turnover.alias("turnover"),
                 (market - p.cost * turnover).alias("growth"))
    return value_path(g, p)


def value_path(growth: DataFrame, p: BacktestParams = BacktestParams(),
               key: str = "portfolio_id", mode: str = "close_hold") -> DataFrame:
    """G4/G6/G7 from per-step growth factors: running product, risk columns,
    reward and the stop rule.  Windows are per series over its steps."""
    w = Window.partitionBy(key).orderBy("step")
    u = w.rowsBetween(UNB, 0)
    v0 = p.initial_value
    df = growth.select(key, "step", "turnover", "growth",
                       F.greatest(F.product("growth").over(u) * v0, F.lit(1e-8)).alias("value"))
    prev_v = F.coalesce(F.lag("value").over(w), F.lit(v0))
    ret = F.col("growth") - 1
    n = F.count(F.lit(1)).over(u)
    df = df.select("*", ret.alias("ret"), (prev_v * p.cost * F.col("turnover")).alias("cost"),
                   F.when(n > 1, F.stddev_pop(ret).over(u)).otherwise(F.lit(0.0)).alias("volatility"),
                   F.greatest(F.max("value").over(u), F.lit(v0)).alias("max_value"))
    dd = (F.col("max_value") - F.col("value")) / F.col("max_value")
    df = df.withColumn("drawdown", dd)
    if mode == "close_hold":
        raw = p.reward_scaling * (F.col("ret") - p.return_rate - F.col("cost") / F.col("value")
                                  - p.risk_penalty * F.col("volatility") - 0.5 * F.col("drawdown"))
        stop = F.col("value") <= p.stop_fraction * v0
    else:  # open_drift: return·scale − 0.5·drawdown, stop below half the start
        raw = F.col("ret") * p.reward_scaling - 0.5 * F.col("drawdown")
        stop = F.col("value") < 0.5 * v0
    df = df.withColumn("reward", F.least(F.greatest(raw, F.lit(p.reward_min)), F.lit(p.reward_max)))
    hit = F.max(F.when(stop, 1).otherwise(0)).over(w.rowsBetween(UNB, -1))
    df = df.withColumn("_ended", F.coalesce(hit, F.lit(0))).filter(F.col("_ended") == 0)
    return df.select(key, (F.col("step") + 1).cast("long").alias("step"), "value", "ret", "cost", "volatility",
                     "max_value", "drawdown", "reward", "turnover")


def equal_weight_benchmark(prices: DataFrame, params: BacktestParams = BacktestParams(),
                           n_steps: int | None = None) -> DataFrame:
    """The same back-test with 1/N weights every step — no turnover, so the
    growth is the cross-sectional mean price relative.  One series, keyed
    ``portfolio_id = 'equal_weight'``."""
    if n_steps is None:
        n_steps = prices.agg(F.countDistinct("step")).first()[0]
    first, last = step_range(n_steps, params.window)
    rel = price_relatives(prices).filter(F.col("step").between(first, last))
    g = rel.groupBy("step").agg(F.avg("rel").alias("growth")).select(
        F.lit("equal_weight").alias("portfolio_id"), "step", F.lit(0.0).alias("turnover"), "growth")
    return value_path(g, params)


def weights_report(actions: DataFrame) -> DataFrame:
    """Explicit weights over time per asset in long form (steps without
    rows hold equal weights)."""
    return normalize_weights(actions).select("portfolio_id", "step", "ticker", "weight")


def open_relatives(prices: DataFrame) -> DataFrame:
    """G2 (older variant): next/current OPEN, both floored at 1e-8, no clip;
    the last step → 1."""
    w = Window.partitionBy("ticker").orderBy("step")
    nxt = F.lead("open").over(w)
    rel = F.when(nxt.isNull(), F.lit(1.0)).otherwise(
        F.greatest(nxt, F.lit(1e-8)) / F.greatest(F.col("open"), F.lit(1e-8)))
    return prices.select("ticker", "step", rel.alias("rel"))


def backtest_open_drift(prices: DataFrame, actions: DataFrame,
                        params: BacktestParams = BacktestParams(),
                        n_steps: int | None = None, n_assets: int | None = None,
                        materialize: bool = True) -> DataFrame:
    """The older simulator.  NEW weights earn the open-to-open move, the
    held weights then drift to a·p/Σa·p, and the turnover (capped at 2) is
    measured against the drifted previous weights; stop below 0.5·V0.

    The drifted weights depend only on step s−1, so the value path keeps its
    closed form.  Equal-weight steps drift to p/Σp — one vector per step
    (calendar × universe), joined where needed; explicit weights stay sparse."""
    p = params
    if n_steps is None or n_assets is None:
        t, n = prices.agg(F.countDistinct("step"), F.countDistinct("ticker")).first()
        n_steps = t if n_steps is None else n_steps
        n_assets = n if n_assets is None else n_assets
    first, last = step_range(n_steps, p.window)
    inv_n = 1.0 / n_assets
    rel = open_relatives(prices).filter(F.col("step").between(first, last))
    rel = _written(rel, "backtest_relatives") if materialize else rel
    per_step = Window.partitionBy("step")
    # Equal weights after drift at step s, used as the "previous" weights at s+1.
    e = rel.select("ticker", (F.col("step") + 1).alias("step"),
                   (F.col("rel") / F.sum("rel").over(per_step)).alias("e"))
    eq_turn = e.groupBy("step").agg(F.sum(F.abs(F.lit(inv_n) - F.col("e"))).alias("eq_turn"))
    m_eq = rel.groupBy("step").agg(F.avg("rel").alias("m_eq"))

    w = weighed(actions, min_total=0.0).withColumn("weight", F.when(F.col("step").between(first, last), F.col("weight")))
    moved = w.join(rel, ["ticker", "step"], "left").join(e, ["ticker", "step"], "left").withColumn("_wr", F.col("weight") * F.col("rel"))
    grp = Window.partitionBy("portfolio_id", "step")
    drift = moved.withColumn("_d", F.col("_wr") / F.sum("_wr").over(grp))
    held = _neighbours(drift, "_d")
    av, ev, dv = F.col("weight"), F.col("e"), F.col("_d")
    own = {"s_ad": F.abs(av - F.coalesce(F.col("before"), F.lit(0.0))), "s_a_eq": F.abs(av - inv_n),
           "s_a_e": F.abs(av - ev) - ev, "kc": F.lit(1.0), "m_sp": F.col("_wr")}
    later = {"s_ad": F.when(~F.col("stays"), F.abs(dv)), "s_d_eq": F.abs(F.lit(inv_n) - dv),
             "kd": F.when(dv.isNotNull(), 1.0)}
    g = (_per_step(held, own, later, first, last)
         .join(m_eq, "step", "left")
         .join(eq_turn, "step", "left"))
    kc, kd = F.coalesce(F.col("kc"), F.lit(0.0)), F.coalesce(F.col("kd"), F.lit(0.0))
    at_start = F.col("step") == first
    turnover = (F.when((kc > 0) & (kd > 0), F.col("s_ad"))
                .when((kc > 0) & at_start, F.col("s_a_eq") + (n_assets - kc) * inv_n)
                .when(kc > 0, F.col("s_a_e") + 1.0)
                .when(kd > 0, F.col("s_d_eq") + (n_assets - kd) * inv_n)
                .when(at_start, F.lit(0.0))
                .otherwise(F.col("eq_turn")))
    turnover = F.least(turnover, F.lit(2.0))
    market = F.when(kc > 0, F.col("m_sp")).otherwise(F.col("m_eq"))
    g = g.select("portfolio_id", "step", turnover.alias("turnover"),
                 (market - p.cost * turnover).alias("growth"))
    return value_path(g, p, mode="open_drift")
