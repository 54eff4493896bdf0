"""Approximate nearest neighbours by collision counting.

Every vector is projected on single directions; per tile and direction the
projections are kept as a sorted array.  A query opens a window around its own
projection in every array, and a vector collides once for each window that
holds it; vectors that collide on at least a fixed share of the directions are
verified with their exact inner product.  Windows widen by virtual rehashing (the
width times a constant, the same arrays) until k vectors are verified.

Largest inner product becomes smallest distance by one extra component,
sqrt(M^2 - |x|^2) with M the largest norm of the tile, zero for a query: the
squared distance is M^2 + |q|^2 - 2 x.q.  Directions come in random orthonormal
sets, which estimate distances with less noise than independent ones.

A vector at distance D is verified by windows of half width reach * D with
probability ``CERTAINTY``, whatever the data: reach is a quantile over the random
directions alone.  A query is done once its windows are that wide for the distance
of its k-th best score so far; what scores higher lies nearer.  So each true
neighbour is found with that probability at least, for any norms, and the
expected recall is no less.

Every row is indexed.  Each tile verifies its own candidates and passes on its k
best, so a query's result merges k rows per tile.  A window's ends are binary
searches in the sorted array; a vector's rank in the array tells whether it
lies between them, so counting touches 16-bit ranks only.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor rows without an id; repeated rows count once (of
several vectors under one id the largest stays); shorter vectors count as filled
with zeros; equal scores go to the smaller id; a table without queries gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import materialize
from tickloom.llm.vectors import finite, n_tiles, one_per_id, padded, pair_arrays, tile_pairs, tiles

QUERY_TILE = 1024
CANDIDATE_TILE = 8192  # below 65,536: ranks are 16-bit
DIRECTION_SETS = 2     # of as many directions as dimensions
COLLISION_SHARE = 0.75
CERTAINTY = 0.999      # of finding a true neighbour
DRAWS = 50_000         # of random vectors for the quantile
WIDTH, WIDEN = 0.7, 1.2  # in standard deviations of a projection
SEED = 20240607

FOUND = "query_id long, vec_id long, score double"


def directions(width: int, sets: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.concatenate([np.linalg.qr(rng.standard_normal((width, width)))[0] for _ in range(sets)], 1)


def reach(width: int, sets: int, share: float, certainty: float) -> float:
    """Half width, for distance one, of windows in which a vector collides on the
    share of the directions with the given probability.  Random directions see
    any one vector as fixed ones see a random vector: its coordinates in each
    orthonormal set are those of a random unit vector."""
    x = np.random.default_rng(0).standard_normal((DRAWS, sets, width))
    x = np.abs(x / np.sqrt((x * x).sum(2, keepdims=True))).reshape(DRAWS, -1)
    least = int(np.ceil(share * sets * width)) - 1
    return float(np.quantile(np.partition(x, least, 1)[:, least], certainty, method="higher"))


class SortedProjections:
    """The sorted arrays of one tile."""

    def __init__(self, vectors: np.ndarray, extra: np.ndarray, axes: np.ndarray):
        shadow = (vectors @ axes[:-1] + extra[:, None] * axes[-1]).T
        order = np.argsort(shadow, axis=1, kind="stable")
        self.sorted = np.take_along_axis(shadow, order, 1)
        self.rank = np.empty(order.shape, np.uint16)
        np.put_along_axis(self.rank, order, np.arange(order.shape[1], dtype=np.uint16)[None, :], 1)
        self.scale = float(shadow.std()) or 1.0

    def windows(self, shadow: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First rank and size of each query's window, per direction."""
        low = np.stack([np.searchsorted(s, q - half) for s, q in zip(self.sorted, shadow)])
        high = np.stack([np.searchsorted(s, q + half, side="right") for s, q in zip(self.sorted, shadow)])
        return low.astype(np.uint16), (high - low).astype(np.uint16)

    def collisions(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How many windows hold each vector."""
        inside = (self.rank - low[:, None]) < size[:, None]  # below the window wraps round to large
        narrow = np.uint8 if len(inside) < 256 else np.uint16  # the count is at most one per direction
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=narrow)


def search(embeddings: DataFrame, is_query, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
           query_tile: int = QUERY_TILE, candidate_tile: int = CANDIDATE_TILE, sets: int = DIRECTION_SETS,
           collision_share: float = COLLISION_SHARE, certainty: float = CERTAINTY,
           seed: int = SEED) -> DataFrame:
    """The k nearest found of every row for which ``is_query(id column)`` holds:
    query_id, rank, vec_id, score."""
    spark = embeddings.sparkSession
    named = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    usable = named.filter(finite(F.col("vec")) & F.exists("vec", lambda x: x != 0))
    doubles = usable.select("vec_id", F.transform("vec", lambda x: x.cast("double")).alias("vec"))
    vectors = materialize(one_per_id(doubles), "ann_vectors")
    said = vectors.agg(F.count("*"), F.count_if(is_query(F.col("vec_id"))), F.max(F.size("vec"))).first()
    n, n_queries, width = said[0], said[1], said[2] or 1
    if not n_queries or n < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n_axes = sets * (width + 1)
    far = reach(width + 1, sets, collision_share, certainty)

    def scan(batches):
        axes = directions(width + 1, sets, seed)
        least = int(np.ceil(collision_share * n_axes))
        for batch in batches:
            for q_ids, queries, c_ids, cand in pair_arrays(batch, np.float64, np.float64):
                square = (cand * cand).sum(1)
                index = SortedProjections(cand, np.sqrt(square.max() - square), axes)
                shadow = (queries @ axes[:-1]).T
                both = square.max() + (queries * queries).sum(1)
                half = np.full(len(q_ids), WIDTH * index.scale)
                open_ = np.arange(len(q_ids))
                found_q, found_c, found_s = [], [], []
                while len(open_):
                    low, size = index.windows(shadow[:, open_], half[open_])
                    all_in = (size == len(c_ids)).all(0)
                    still = []
                    for j, q in enumerate(open_.tolist()):
                        if all_in[j]:
                            picked = np.arange(len(c_ids))
                        else:
                            picked = np.flatnonzero(index.collisions(low[:, j], size[:, j]) >= least)
                        picked = picked[c_ids[picked] != q_ids[q]]
                        score = cand[picked] @ queries[q]
                        bar = np.partition(score, len(picked) - k)[len(picked) - k] if len(picked) >= k else -np.inf
                        if not all_in[j]:
                            # What scores at least the bar lies within this distance.
                            wide = far * np.sqrt(max(both[q] - 2 * bar, 0.0)) * (1 + 1e-9)
                            if half[q] < wide:
                                half[q] = min(wide, half[q] * WIDEN) if len(picked) < k else wide
                                still.append(q)
                                continue
                        if len(picked) > k:  # near ties stay until the final cut
                            picked = picked[score >= bar - 1e-9 * (1 + abs(bar))]
                        found_q.append(np.full(len(picked), q_ids[q]))
                        found_c.append(c_ids[picked])
                        # One order of summation for all: equal vectors, equal scores.
                        found_s.append((cand[picked] * queries[q]).sum(1))
                    open_ = np.array(still, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found_q)), pa.array(np.concatenate(found_c)),
                     pa.array(np.concatenate(found_s))], names=["query_id", "vec_id", "score"])

    def matrix(vec):
        return padded(vec, width, np.float64)

    q_tiles, c_tiles = n_tiles(n_queries, query_tile), n_tiles(n, candidate_tile)
    pairs = tile_pairs(tiles(vectors.filter(is_query(F.col("vec_id"))), q_tiles, matrix), q_tiles,
                       tiles(vectors, c_tiles, matrix), c_tiles)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.mapInArrow(scan, FOUND).withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
