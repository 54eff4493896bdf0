"""Quality classifier: generalised additive model with pairwise interactions.

Text statistics are cut into quantile bins.  Cyclic boosting takes the features
in turn; each step fits a shallow tree on one feature's bins to the current
gradients and adds it, shrunk, to the feature's lookup table.  Then the pairs
whose joint table would lower the loss most are boosted the same way, a split
on one feature followed by a split of each side on the other.  A document's
score is the logistic of one table entry per feature and pair: additions over
bins, vectorised over documents.

The tables are learned on the driver from at most ``max_rows`` labelled rows (a
documented parameter; only their statistics are collected).  Every document is
scored whole, in one pass without a shuffle.

Defined cases: a null text is empty; an empty text has zero for every statistic
and gets a score from the tables like any other; without usable labels every
score is 0.5; repeated rows are scored alike; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import append_columns, bytes_of, labelled_sample
from tickloom.llm.wordhash import U64, span_hashes, white_space, word_spans

MAX_ROWS = 20_000
BINS = 32
ROUNDS, PAIR_ROUNDS, RATE, PAIRS = 120, 60, 0.1, 8
SMOOTH = 1.0  # added to every leaf's curvature

FEATURES = ("log_words", "log_bytes", "word_bytes", "long_word_share", "short_word_share", "distinct_word_share",
            "repeated_neighbour_share", "top_word_share", "upper_share", "digit_share", "non_ascii_share",
            "end_mark_share", "exclamation_share", "bar_share", "symbol_share", "line_share", "distinct_line_share")


def byte_classes() -> dict[str, np.ndarray]:
    def has(*values):
        t = np.zeros(256, bool)
        t[list(values)] = True
        return t

    return {"upper": has(*range(65, 91)), "letter": has(*range(65, 91), *range(97, 123), *range(192, 256)),
            "digit": has(*range(48, 58)), "high": has(*range(192, 256)), "end": has(*b".?"), "shout": has(*b"!"),
            "bar": has(*b"|"), "symbol": has(*b"#$%&*+<=>@[]^_{}~\\/"), "line": has(10)}


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of statistics per text."""
    raw, off = bytes_of(texts)
    n = len(off) - 1

    def per_text(mask_or_values):
        sums = np.concatenate([[0.0], np.cumsum(mask_or_values, dtype=np.float64)])
        return sums[off[1:]] - sums[off[:-1]]

    counts = {k: per_text(t[raw]) for k, t in byte_classes().items()}
    size = np.diff(off).astype(float)
    starts, ends, first = word_spans(raw, off, white_space())
    words = np.diff(first)
    owner = np.repeat(np.arange(n), words)
    length = ends - starts
    hashes = span_hashes(raw, starts, ends)

    def by_word(values):
        return np.bincount(owner, values, n)

    order = np.sort((owner.astype(U64) << U64(40)) | (hashes >> U64(24)))
    fresh = np.concatenate([[True], order[1:] != order[:-1]]) if len(order) else np.zeros(0, bool)
    distinct = np.bincount((order[fresh] >> U64(40)).astype(np.int64), minlength=n)
    at = np.flatnonzero(fresh)
    runs = np.diff(at, append=len(order))
    top = np.zeros(n)
    np.maximum.at(top, (order[at] >> U64(40)).astype(np.int64), runs)
    same = np.zeros(len(hashes))
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    newline = np.zeros(256, bool)
    newline[10] = True
    l_start, l_end, l_first = word_spans(raw, off, newline)
    l_owner = np.repeat(np.arange(n), np.diff(l_first))
    l_key = np.unique((l_owner.astype(U64) << U64(40)) | (span_hashes(raw, l_start, l_end) >> U64(24)))
    l_distinct = np.bincount((l_key >> U64(40)).astype(np.int64), minlength=n)

    def share(a, b):
        return a / np.maximum(b, 1)

    return np.stack([
        np.log1p(words), np.log1p(size), share(by_word(length), words), share(by_word(length > 12), words),
        share(by_word(length <= 3), words), share(distinct, words), share(by_word(same), words), share(top, words),
        share(counts["upper"], counts["letter"]), share(counts["digit"], size), share(counts["high"], size),
        share(counts["end"], words), share(counts["shout"], words), share(counts["bar"], words),
        share(counts["symbol"], words), share(counts["line"], words), share(l_distinct, np.diff(l_first)),
    ], 1)


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables."""

    edges: list[np.ndarray]
    base: float = 0.0
    tables: np.ndarray = field(default_factory=lambda: np.zeros((0, BINS)))
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for j, table in enumerate(self.tables):
            out += table[bins[:, j]]
        for a, b, table in self.pairs:
            out += table[bins[:, a], bins[:, b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(self.bins(x))))


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """The cut of a histogram whose two sides lower the loss most, and by how
    much: (bins up to and with it go left, gain)."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + SMOOTH) + gr ** 2 / (hr + SMOOTH) - g.sum() ** 2 / (h.sum() + SMOOTH)
    at = int(np.argmax(gain))
    return at, float(gain[at])


def shallow_tree(g: np.ndarray, h: np.ndarray, splits: int = 3) -> np.ndarray:
    """Values per bin of a tree with at most ``splits`` cuts, best first."""
    leaves = [(0, len(g))]
    for _ in range(splits):
        best = (1e-9, None, 0)
        for k, (a, b) in enumerate(leaves):
            if b - a > 1:
                at, gain = best_cut(g[a:b], h[a:b])
                best = max(best, (gain, k, a + at + 1), key=lambda t: t[0])
        if best[1] is None:
            break
        a, b = leaves.pop(best[1])
        leaves += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + SMOOTH)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values per cell of a tree that cuts on the first feature, then each side
    on the second; and its gain."""
    at, _ = best_cut(g.sum(1), h.sum(1))
    out, gain = np.zeros(g.shape), -g.sum() ** 2 / (h.sum() + SMOOTH)
    for rows in (slice(0, at + 1), slice(at + 1, None)):
        gs, hs = g[rows].sum(0), h[rows].sum(0)
        cut, _ = best_cut(gs, hs)
        for cols in (slice(0, cut + 1), slice(cut + 1, None)):
            total, weight = gs[cols].sum(), hs[cols].sum() + SMOOTH
            out[rows, cols] = -total / weight
            gain += total ** 2 / weight
    return out, float(gain)


def fit(x: np.ndarray, y: np.ndarray, n_pairs: int = PAIRS, rounds: int = ROUNDS,
        pair_rounds: int = PAIR_ROUNDS) -> AdditiveModel:
    """Boost the tables on statistics ``x`` and labels ``y``."""
    share = np.linspace(0, 1, BINS + 1)[1:-1]
    columns = x.shape[1]
    model = AdditiveModel([np.unique(np.quantile(x[:, j], share)) if len(x) else np.zeros(0) for j in range(columns)],
                          tables=np.zeros((columns, BINS)))
    if not len(y):
        return model
    rate = (y.sum() + 1) / (len(y) + 2)
    model.base = float(np.log(rate / (1 - rate)))
    bins = model.bins(x)
    margin = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j in range(columns):
            g, h = slopes()
            b = bins[:, j]
            step = RATE * shallow_tree(np.bincount(b, g, BINS), np.bincount(b, h, BINS))
            model.tables[j] += step
            margin += step[b]

    def joint(a, b):
        g, h = slopes()
        key = bins[:, a] * BINS + bins[:, b]
        return tuple(np.bincount(key, v, BINS * BINS).reshape(BINS, BINS) for v in (g, h))

    ranked = sorted(((max(pair_tree(*joint(a, b))[1], pair_tree(*(t.T for t in joint(a, b)))[1]), a, b)
                     for a in range(columns) for b in range(a + 1, columns)), key=lambda t: (-t[0], t[1], t[2]))
    model.pairs = [(a, b, np.zeros((BINS, BINS))) for _, a, b in ranked[:n_pairs]]
    for _ in range(pair_rounds):
        for a, b, table in model.pairs:
            g, h = joint(a, b)
            one, gain_one = pair_tree(g, h)
            two, gain_two = pair_tree(g.T, h.T)
            step = RATE * (one if gain_one >= gain_two else two.T)
            table += step
            margin += step[bins[:, a], bins[:, b]]
    return model


def learn(docs: DataFrame, labels: DataFrame, wanted: Column, max_rows: int = MAX_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> AdditiveModel:
    """Fit on the labelled documents for which ``wanted`` (over doc_id) holds."""
    sample = F.broadcast(labelled_sample(labels, "quality", wanted, max_rows))  # max_rows rows of 12 bytes
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = append_columns(named.join(sample, "doc_id"), "text", "stats array<double>",
                          lambda: lambda texts: [pa.array(list(text_features(texts)), pa.list_(pa.float64()))])
    # One row per id, so that what is collected stays within max_rows.
    got = rows.groupBy("doc_id").agg(F.min(F.struct("stats", "label")).alias("r")).select("r.*").toArrow()
    x = got.column("stats").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    y = got.column("label").to_numpy().astype(float)
    order = np.lexsort(np.concatenate([x.T, y[None]])) if len(y) else slice(None)
    return fit(x[order], y[order])


def with_quality(docs: DataFrame, model: AdditiveModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (1: like good documents)."""
    return append_columns(docs, text_col, f"`{score_col}` double",
                          lambda: lambda texts: [pa.array(model.score(text_features(texts)))])
