"""F28 — rolling correlations of chosen pairs, from tiles of moment matrices.

Tickers are dealt into blocks by a hash; a tile is a pair of blocks and holds the
series of its pairs only, one calendar long each.  A task takes one tile and forms
the windows' moments of all its pairs from centred windows, so a series is
shuffled once per tile it has a partner in, not once per pair, and no join puts
pairs of rows through a shuffle.  Work and output grow with the partner table.

Beside the bars (``beside_partners``) nothing but the bars crosses an exchange in
full: a partner's series goes once to every part of the bars that needs it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.packed import by_part, pack, part_of, parts, payload
from tickloom.functions.wide import finite_or_null, first_rows, next_valid
from tickloom.operators.bars import OpenBars
from tickloom.operators.joins import mirror_pairs
from tickloom.session import materialize

BLOCK = 32  # tickers of a block
FEW = 50_000  # partners whose names may be sent to every task


def rolling_correlation(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Sample correlation of every ``n`` consecutive rows, NaN until n rows hold
    both values, and where either is constant."""
    out = np.full(len(x), np.nan)
    if len(x) < n:
        return out
    both = ~(np.isnan(x) | np.isnan(y))
    full = np.flatnonzero(sliding_window_view(both, n).all(1))
    a, b = sliding_window_view(x, n)[full], sliding_window_view(y, n)[full]
    moving = (a.max(1, initial=-np.inf) > a.min(1, initial=np.inf)) & (b.max(1, initial=-np.inf) > b.min(1, initial=np.inf))
    full, a, b = full[moving], a[moving], b[moving]
    a, b = a - a.mean(1, keepdims=True), b - b.mean(1, keepdims=True)
    spread = np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1))
    with np.errstate(divide="ignore", invalid="ignore"):
        out[full + n - 1] = np.where(spread > 0, (a * b).sum(1) / spread, np.nan)
    return out


def pair_correlations(panel: DataFrame, partners: DataFrame, windows=(10, 20, 60), backfill: bool = True,
                      value: str = "close", order: str = "date", block: int = BLOCK) -> DataFrame:
    """(ticker, other, date, Corr_{n}d) for the ordered pairs of
    ``partners(ticker, other)`` on the dates both series have a row for; windows
    count those rows.  Every unordered pair is computed once."""
    wanted = partners.select("ticker", "other").distinct().filter(F.col("ticker") != F.col("other"))
    half = wanted.select(F.least("ticker", "other").alias("a"), F.greatest("ticker", "other").alias("b")).distinct()
    members = wanted.select(F.explode(F.array("ticker", "other")).alias("ticker"))
    n_blocks = max(1, -(-members.distinct().count() // block))  # one number; tiles stay of one size as the universe grows

    def home(c):
        return F.pmod(F.xxhash64(c), F.lit(n_blocks))

    pairs = half.select("a", "b", F.least(home("a"), home("b")).alias("_p"), F.greatest(home("a"), home("b")).alias("_q"))
    needed = pairs.select(F.col("_p").alias("_s"), F.col("_q").alias("_t"), F.explode(F.array("a", "b")).alias("ticker")).distinct()
    series = panel.filter(F.col("ticker").isNotNull() & F.col(order).isNotNull()).select(
        "ticker", order, F.col(value).cast("double").alias("x")).join(needed, "ticker")
    names = [f"Corr_{n}d" for n in windows]
    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("other", T.StringType()),
                           panel.schema[order], *[T.StructField(c, T.DoubleType()) for c in names]])

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by([("ticker", "ascending"), (order, "ascending")]).combine_chunks()
        cells = right.column("ticker").combine_chunks().dictionary_encode()
        cells = cells if isinstance(cells, pa.DictionaryArray) else cells.combine_chunks()
        codes = cells.indices.to_numpy()
        edge = np.flatnonzero(np.diff(codes, prepend=-1, append=-1))
        rows = {name: (edge[i], edge[i + 1]) for i, name in enumerate(cells.dictionary.to_pylist())}
        days = right.column(order).to_numpy()
        x = right.column("x").to_numpy(zero_copy_only=False)
        out = {c: [] for c in schema.fieldNames()}
        for a, b in zip(left.column("a").to_pylist(), left.column("b").to_pylist()):
            if a not in rows or b not in rows:
                continue
            (a0, a1), (b0, b1) = rows[a], rows[b]
            common, i, j = np.intersect1d(days[a0:a1], days[b0:b1], return_indices=True)
            out["ticker"].append(np.repeat(a, len(common)))
            out["other"].append(np.repeat(b, len(common)))
            out[order].append(common)
            for n, c in zip(windows, names):
                r = rolling_correlation(x[a0:a1][i], x[b0:b1][j], n)
                out[c].append(next_valid(r) if backfill else r)
        kind = right.schema.field(order).type
        types = {"ticker": pa.string(), "other": pa.string(), order: kind}
        return pa.table({c: pa.array(np.concatenate(v) if v else [], types.get(c, pa.float64()),
                                     from_pandas=True) for c, v in out.items()})

    found = pairs.groupBy("_p", "_q").cogroup(series.groupBy("_s", "_t")).applyInArrow(tile, schema)
    return mirror_pairs(found).join(wanted, ["ticker", "other"], "left_semi")


def spans(table: pa.Table) -> dict:
    """Where each ticker's rows lie, in rows sorted by ticker."""
    starts = first_rows(table, ["ticker"])
    return dict(zip(table.column("ticker").take(pa.array(starts)).to_pylist(), zip(starts, [*starts[1:], table.num_rows])))


def correlated(bars: pa.Table, pairs: pa.Table, series: pa.Table, ranks: int, windows, order: str) -> dict[str, pa.Array]:
    """Corr_{rank}_{n}d of ``bars``, sorted by ticker and date, undated ones last:
    ``pairs(ticker, other, rank)`` name the partners, ``series(ticker, date, x)``
    holds their values."""
    out = {(r, n): np.full(bars.num_rows, np.nan) for r in range(1, ranks + 1) for n in windows}
    series = series.sort_by([("ticker", "ascending"), (order, "ascending")])
    mine, theirs = spans(bars), spans(series)
    dated = bars.column(order).is_valid().to_numpy()
    days, their_days = bars.column(order).to_numpy(), series.column(order).to_numpy()
    x, their_x = (t.column(c).to_numpy().astype(np.float64) for t, c in ((bars, "close"), (series, "x")))
    for ticker, other, rank in zip(*(pairs.column(c).to_pylist() for c in ("ticker", "other", "rank"))):
        if ticker not in mine or other not in theirs:
            continue
        (a, b), (c, d) = mine[ticker], theirs[other]
        b = a + int(dated[a:b].sum())
        common, i, j = np.intersect1d(days[a:b], their_days[c:d], return_indices=True)
        if not len(common):
            continue
        at = np.minimum(np.searchsorted(common, days[a:b]), len(common) - 1)
        met = common[at] == days[a:b]
        for n in windows:
            cells, r = out[rank, n][a:b], rolling_correlation(x[a:b][i], their_x[c:d][j], n)
            cells[met] = np.fmax(cells[met], r[at[met]])
    return {f"Corr_{r}_{n}d": finite_or_null(v) for (r, n), v in out.items()}


def beside_partners(bars: DataFrame | OpenBars, partners: DataFrame | None, ranks: int, windows, then, schema: T.StructType,
                    order: str = "date") -> DataFrame:
    """What ``then`` makes of the bars of each part, whole series in order, with the
    correlations of every bar's ticker and its partners beside them.  Bars, open or
    not, cross one exchange in blocks; so do the pairs and, once for every part that
    has a pair with it, a partner's series.  The number of parts and the partners'
    bars are found first: a frame of bars that is dear to compute should be written
    before."""
    is_open = isinstance(bars, OpenBars)
    rows = bars.rows if is_open else bars
    n = parts(rows.sparkSession, bars.count())
    rows = rows.select(part_of(n, "ticker"), *rows.columns)
    joined, closed = (bars.combining(), bars.closing()) if is_open else (None, None)
    blocks, kinds = pack(rows, kind=0, combine=joined), [(payload(rows), joined)]
    if partners is not None:
        few = materialize(partners.filter(F.col("rank").between(1, ranks) & (F.col("ticker") != F.col("other"))).select(
            "ticker", "other", F.col("rank").cast("int").alias("rank")).distinct(), "partners")
        pairs = few.select(part_of(n, "ticker"), *few.columns)
        wanted = pairs.select(F.col("other").alias("_of"), "_part").distinct()
        others = few.select(F.col("other").alias("ticker")).distinct()
        if others.count() <= FEW:  # the bars, or their ticks, are not exchanged for it
            others = F.broadcast(others)
        found = bars.of(others) if is_open else bars.join(others, "ticker", "left_semi")
        series = found.filter(F.col(order).isNotNull()).select(
            F.col("ticker").alias("_of"), "ticker", order, F.col("close").cast("double").alias("x"))
        sent = pack(series, "_of", kind=2).join(wanted, "_of").drop("_of")
        blocks = blocks.unionByName(pack(pairs, kind=1)).unionByName(sent)
        kinds += [(payload(pairs), None), (payload(series, "_of"), None)]

    def compute(table, pairs=None, series=None):
        if not table.num_rows:
            return
        if closed is not None:
            table = closed(table)
        else:
            table = table.take(pc.sort_indices(table, sort_keys=[("ticker", "ascending"), (order, "ascending")], null_placement="at_end"))
        if pairs is not None:
            for c, v in correlated(table, pairs, series, ranks, windows, order).items():
                table = table.append_column(c, v)
        yield from then(table)

    return by_part(blocks, n, kinds, compute, schema)
