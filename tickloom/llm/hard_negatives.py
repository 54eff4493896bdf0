"""Hard-negative mining with segment summaries.

Anchors look for their best rows of the same label (positives) and, for every
positive, for the best rows of another label whose score lies in a stated share of
the positive's (hard negatives too close to it are left out as likely
mislabelled, those too far as easy).

Method.  Vectors are cut into segments; each segment's mean and deviation is
stored.  With a segment of L components, x . y lies within
L * mean_x * mean_y -+ L * dev_x * dev_y; the sums over all segments bound a score
from both sides.  Pairs are bounded with few segments first; only those that may
still enter go on to finer segments, and only what is left is scored exactly.
A bound that cannot reach the best scores found so far, or lies outside the wanted
range, discards the pair; nothing else does, so results are exact.

Anchors and candidates are dealt into tiles by a hash of the id; a task holds one
tile of anchors and a bounded group of candidate tiles, and returns its k best
of each anchor, which are merged by rank.  Scores found in one tile raise the bar
for the task's following tiles.

Defined cases: rows whose label, id or vector is null, or whose vector is empty
or holds a null or non-finite component, take no part; rows that repeat an id
count once (the largest vector, then label); shorter vectors count as filled
with zeros; equal scores go to the smaller id; an anchor without positives, or a
positive without negatives in range, gives no rows; a pair whose product leaves the long
range is left out; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import materialize, spare
from tickloom.llm.vectors import finite, n_tiles, padded

SEGMENTS = (4, 16)      # segments of every level, coarse to fine
ANCHOR_TILE = 256
CANDIDATE_TILE = 4096
GROUP = 4               # candidate tiles of a task
STRIP = 1024            # candidates bounded at once

MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
SCORED = "anchor_id long, vec_id long, score long"
RANGED = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"
TILE = "tile int, ids binary, labels binary, vectors binary, means binary, deviations binary, targets binary"


def summaries(m: np.ndarray, levels) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(L) * mean and sqrt(L) * deviation of every segment, the levels'
    segments side by side."""
    means, deviations = [], []
    for n in levels:
        for part in np.array_split(m.astype(np.float64), n, axis=1):
            root = np.sqrt(part.shape[1])
            means.append(part.mean(1) * root if part.shape[1] else np.zeros(len(m)))
            deviations.append(part.std(1) * root if part.shape[1] else np.zeros(len(m)))
    return np.stack(means, 1), np.stack(deviations, 1)


class Tile:
    """Rows of one packed tile."""

    def __init__(self, packed: dict, width: int):
        self.ids, self.labels = (np.frombuffer(packed[c], np.int64) for c in ("ids", "labels"))
        self.exact = np.frombuffer(packed["vectors"], np.int64).reshape(-1, width)
        self.means, self.deviations = (np.frombuffer(packed[c], np.float64).reshape(len(self.ids), -1)
                                       for c in ("means", "deviations"))
        self.targets = np.frombuffer(packed["targets"], np.int64).reshape(-1, 3)  # row, positive, its score
        self.norm = np.sqrt((self.exact.astype(np.float64) ** 2).sum(1))


def pack(rows: DataFrame, tiles: int, width: int, levels) -> DataFrame:
    """One row per tile of (vec_id, label, vec[, positives])."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id").combine_chunks()
        m = np.ascontiguousarray(padded(table.column("vec").chunk(0), width, np.int64))
        means, deviations = summaries(m, levels)
        targets = np.zeros((0, 3), np.int64)
        if "positives" in table.column_names:
            lists = table.column("positives").to_pylist()
            targets = np.array([(i, p["vec_id"], p["score"]) for i, ps in enumerate(lists) for p in ps],
                               np.int64).reshape(-1, 3)
        binary = {"ids": table.column("vec_id").to_numpy(), "labels": table.column("label").to_numpy(), "vectors": m,
                  "means": means, "deviations": deviations, "targets": targets}
        return pa.table({"tile": table.column("tile")[:1].cast(pa.int32()),
                         **{c: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for c, v in binary.items()}})

    return (rows.withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).cast("int"))
            .groupBy("tile").applyInArrow(run, TILE))


def scores(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact inner products of paired rows, and whether each fits a long."""
    size = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if size < 2.0 ** 53:
        out = np.einsum("ij,ij->i", a.astype(np.float64), b.astype(np.float64)).astype(np.int64)
    elif size < 2.0 ** 62:
        out = np.einsum("ij,ij->i", a, b)
    else:
        whole = (a.astype(object) * b.astype(object)).sum(1)
        fits = np.array([-2 ** 63 <= x < 2 ** 63 for x in whole], bool)
        return np.where(fits, whole, 0).astype(np.int64), fits
    return out, np.ones(len(out), bool)


def best(owner: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int, n: int):
    """The k best of every owner in order, and the owner's bar: its k-th score,
    or the smallest long."""
    order = np.lexsort((ids, ~score, owner))  # ~x = -x - 1 cannot overflow
    owner, ids, score = owner[order], ids[order], score[order]
    first = np.searchsorted(owner, np.arange(n))
    place = np.arange(len(owner)) - first[owner]
    keep = place < k
    bar = np.full(n, np.iinfo(np.int64).min)
    last = place == k - 1
    bar[owner[last]] = score[last]
    return owner[keep], ids[keep], score[keep], bar


def refined(anchors: Tile, rows: Tile, allowed: np.ndarray, at: int, floor: np.ndarray, roof: np.ndarray, levels):
    """Exact scores of the pairs (anchor, candidate at + column) that ``allowed``
    lets in and whose bounds reach from floor to roof of the anchor."""
    stop = at + allowed.shape[1]
    slack = 1e-9 * anchors.norm[:, None] * rows.norm[None, at:stop]
    begin = 0
    i = j = None
    for n in levels:
        part = slice(begin, begin + n)
        begin += n
        am, ad, rm, rd = anchors.means[:, part], anchors.deviations[:, part], rows.means[:, part], rows.deviations[:, part]
        if i is None:
            middle, spread = am @ rm[at:stop].T, ad @ rd[at:stop].T + slack
            i, j = np.nonzero(allowed & (middle + spread >= floor[:, None]) & (middle - spread <= roof[:, None]))
        else:
            middle = np.einsum("ij,ij->i", am[i], rm[at + j])
            spread = np.einsum("ij,ij->i", ad[i], rd[at + j]) + slack[i, j]
            keep = (middle + spread >= floor[i]) & (middle - spread <= roof[i])
            i, j = i[keep], j[keep]
    score, fits = scores(anchors.exact[i], rows.exact[at + j])
    return i[fits], at + j[fits], score[fits]


def tile_groups(anchors: DataFrame, a_tiles: int, candidates: DataFrame, c_tiles: int, group: int):
    """Both sides keyed by (anchor tile, group of candidate tiles)."""
    groups = n_tiles(c_tiles, group)
    left = anchors.select("*", F.col("tile").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
    right = candidates.select("*", F.explode(F.sequence(F.lit(0), F.lit(a_tiles - 1))).alias("q"),
                              (F.col("tile") % groups).alias("g"))
    tasks = a_tiles * groups
    return (left.repartition(tasks, "q", "g").groupBy("q", "g"),
            right.repartition(tasks, "q", "g").groupBy("q", "g"))


def opened(table: pa.Table, width: int):
    for row in table.sort_by("tile").to_pylist():
        yield Tile(row, width)


def mine(rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 10, low_share: int = 30,
         high_share: int = 90, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "vec",
         levels=SEGMENTS, anchor_tile: int = ANCHOR_TILE, candidate_tile: int = CANDIDATE_TILE,
         group: int = GROUP) -> DataFrame:
    """For every row for which ``is_anchor(id column)`` holds, its ``positives``
    best rows of the same label, and for each of them the ``negatives`` best rows
    of other labels with a score of ``low_share`` to ``high_share`` percent of the
    positive's.  ``vec_col`` holds integer vectors, ``label_col`` integers."""
    spark = rows.sparkSession
    named = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                        F.col(vec_col).cast("array<long>").alias("vec"))
    usable = named.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vec")))
    one = usable.groupBy("vec_id").agg(F.max(F.struct("vec", "label")).alias("r")).select("vec_id", "r.label", "r.vec")
    one = materialize(one, "mining_rows")
    anchor: Column = is_anchor(F.col("vec_id"))
    n, n_anchors, width = one.agg(F.count("*"), F.count_if(anchor), F.max(F.size("vec"))).first()
    if not n_anchors or n < 2:
        return spark.createDataFrame([], MINED)
    a_tiles, c_tiles = n_tiles(n_anchors, anchor_tile), n_tiles(n, candidate_tile)
    candidates = materialize(pack(one, c_tiles, width, levels), "mining_tiles")
    everything = np.iinfo(np.int64)

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            a = next(opened(left, width))
            count = len(a.ids)
            held = tuple(np.zeros(0, np.int64) for _ in range(3))
            bar = np.full(count, everything.min)
            for c in opened(right, width):
                for at in range(0, len(c.ids), STRIP):
                    cut = slice(at, at + STRIP)
                    allowed = (a.labels[:, None] == c.labels[None, cut]) & (a.ids[:, None] != c.ids[None, cut])
                    i, j, s = refined(a, c, allowed, at, bar.astype(np.float64), np.full(count, np.inf), levels)
                    held = (np.concatenate([held[0], i]), np.concatenate([held[1], c.ids[j]]), np.concatenate([held[2], s]))
                    *held, bar = best(*held, positives, count)
            out = [a.ids[held[0]], held[1], held[2]]
            spare()
        return pa.table(dict(zip(("anchor_id", "vec_id", "score"), out or [np.zeros(0, np.int64)] * 3)))

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            a = next(opened(left, width))
            owner, positive, ps = a.targets.T  # by anchor
            floor = -(-low_share * ps.astype(object) // 100) if len(ps) else ps.astype(object)
            roof = high_share * ps.astype(object) // 100
            edge = (everything.min, everything.max)
            floor, roof = (np.array([min(max(x, edge[0]), edge[1]) for x in v], np.int64) for v in (floor, roof))
            held = tuple(np.zeros(0, np.int64) for _ in range(3))
            bar = floor.copy()
            first = np.searchsorted(owner, np.arange(len(a.ids) + 1))
            sought = np.zeros(len(a.ids), bool)
            sought[owner[floor <= roof]] = True
            for c in opened(right, width):
                for at in range(0, len(c.ids), STRIP):
                    cut = slice(at, at + STRIP)
                    low, high = np.full(len(a.ids), np.inf), np.full(len(a.ids), -np.inf)
                    np.minimum.at(low, owner, bar.astype(np.float64))
                    np.maximum.at(high, owner, roof.astype(np.float64))
                    allowed = (a.labels[:, None] != c.labels[None, cut]) & sought[:, None]
                    i, j, s = refined(a, c, allowed, at, low, high, levels)
                    reps = first[i + 1] - first[i]  # every positive of the anchor
                    target = np.repeat(first[i], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
                    j, s = np.repeat(j, reps), np.repeat(s, reps)
                    fits = (s >= bar[target]) & (s <= roof[target])
                    held = (np.concatenate([held[0], target[fits]]), np.concatenate([held[1], c.ids[j[fits]]]),
                            np.concatenate([held[2], s[fits]]))
                    *held, kth = best(*held, negatives, len(owner))
                    bar = np.maximum(bar, kth)
            out = [a.ids[owner[held[0]]], positive[held[0]], ps[held[0]], held[1], held[2]]
            spare()
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score", "vec_id", "score"),
                                 out or [np.zeros(0, np.int64)] * 5)))

    def searched(anchors, find, schema):
        left, right = tile_groups(anchors, a_tiles, candidates, c_tiles, group)
        return left.cogroup(right).applyInArrow(lambda a, b: find(a, b), schema)

    asked = one.filter(anchor)
    of_anchor = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    good = (searched(pack(asked, a_tiles, width, levels), find_positives, SCORED)
            .withColumn("place", F.row_number().over(of_anchor)).filter(F.col("place") <= positives)
            .groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("positives")))
    with_targets = materialize(asked.join(good, asked["vec_id"] == good["anchor_id"]).select(
        "vec_id", "label", "vec", "positives"), "mining_anchors")
    of_pair = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    return (searched(pack(with_targets, a_tiles, width, levels), find_negatives, RANGED)
            .withColumn("rank", F.row_number().over(of_pair).cast("int")).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
