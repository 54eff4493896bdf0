"""The closed-form back-test against a plain step-by-step loop of the
environment's rules, on the sf0.001 brand panel and supplier actions."""

import math

import numpy as np

from tickloom.operators import backtest as G
from tickloom.plans import market as M

SF = "/root/testdata/sf0.001"


def loop_backtest(close, actions, p: G.BacktestParams):
    """close: [T, N] array; actions: dict step -> raw vector (absent = zeros)."""
    T, N = close.shape
    first, last = G.step_range(T, p.window)
    v, w = p.initial_value, np.full(N, 1.0 / N)
    vmax, rets, out = v, [], []
    for s in range(first, last + 1):
        raw = actions.get(s, np.zeros(N))
        if np.isnan(raw).any() or np.isinf(raw).any():
            new = np.full(N, 1.0 / N)
        else:
            a = np.maximum(raw, 0.0)
            new = a / a.sum() if a.sum() > 1e-8 else np.full(N, 1.0 / N)
        if s + 1 >= T:
            rel = np.ones(N)
        else:
            rel = np.where(close[s] > 1e-8, close[s + 1] / np.where(close[s] > 1e-8, close[s], 1), 1.0)
            rel = np.clip(rel, 0.1, 10.0)
        cost = v * p.cost * np.abs(new - w).sum()
        old_v = v
        v = max((v * w * rel).sum() - cost, 1e-8)
        w = new
        ret = v / old_v - 1
        rets.append(ret)
        vmax = max(vmax, v)
        vol = float(np.std(rets)) if len(rets) > 1 else 0.0
        dd = (vmax - v) / vmax
        reward = p.reward_scaling * (ret - p.return_rate - cost / v - p.risk_penalty * vol - 0.5 * dd)
        reward = min(max(reward, p.reward_min), p.reward_max)
        out.append((s + 1, v, ret, cost, vol, dd, reward))
        if v <= p.stop_fraction * p.initial_value:
            break
    return out


def test_closed_form_matches_loop(spark):
    panel = M.price_panel(spark, SF)
    acts = M.portfolio_actions(spark, SF)
    tickers = sorted(r[0] for r in panel.select("ticker").distinct().collect())
    pc = {(r.ticker, r.step): r.close for r in panel.select("ticker", "step", "close").collect()}
    T = 1 + max(s for _, s in pc)
    close = np.array([[pc[(t, s)] for t in tickers] for s in range(T)])
    ports = sorted(r[0] for r in acts.select("portfolio_id").distinct().collect())[:4]
    rows = acts.filter(acts.portfolio_id.isin(ports)).collect()
    bt = G.backtest(panel, acts.filter(acts.portfolio_id.isin(ports))).collect()
    p = G.BacktestParams()
    for pid in ports:
        a = {}
        for r in rows:
            if r.portfolio_id == pid:
                a.setdefault(r.step, np.zeros(len(tickers)))[tickers.index(r.ticker)] += r.raw
        want = loop_backtest(close, a, p)
        got = sorted((r.step, r.value, r.ret, r.cost, r.volatility, r.drawdown, r.reward)
                     for r in bt if r.portfolio_id == pid)
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[0] == w[0]
            for x, y in zip(g[1:], w[1:]):
                assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (pid, g, w)
