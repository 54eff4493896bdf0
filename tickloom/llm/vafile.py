"""Exact top-k by inner product with a vector-approximation file.

Each dimension is cut into cells at quantiles of a bounded sample, the outer
cells reaching to the true minimum and maximum over all rows; a vector's
approximation is one byte per dimension.  Step one scans the approximations
only: cell edges bound every score from both sides, and a candidate stays if
its upper bound reaches the k-th best lower bound.  Step two reads exact vectors
in bound order: first the k candidates with the best bounds, then those whose
bound still reaches the k-th exact score found; nothing else can enter, so the
result is exact.

The cells only steer how much is read; any sample gives the same result.

Defined cases: vectors that are null, empty or hold a null or non-finite
component take no part, nor do rows without an id; repeated rows count once (of
several vectors under one id the largest stays); shorter vectors count as filled
with zeros; equal scores go to the smaller id; a table without queries or
without candidates gives no rows; components too large for a long saturate, and
a pair whose product leaves the long range is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import materialize
from tickloom.llm.vectors import finite, n_tiles, one_per_id, padded, pair_arrays, tile_pairs, tiles

QUERY_TILE = 1024
CANDIDATE_TILE = 8192
CELL_BITS = 6
SAMPLE_ROWS = 4096

SURVIVORS = "query_id long, vec_id long, lower double, upper double"


def extremes(vectors: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of every dimension over all rows; each task sends
    one row per dimension."""

    def run(batches):
        low, high = np.full(width, np.iinfo(np.int64).max), np.full(width, np.iinfo(np.int64).min)
        for batch in batches:
            if batch.num_rows:
                m = padded(batch.column("vec"), width, np.int64)
                low, high = np.minimum(low, m.min(0)), np.maximum(high, m.max(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(low), pa.array(high)],
                                         names=["dim", "low", "high"])

    rows = (vectors.select("vec").mapInArrow(run, "dim long, low long, high long").groupBy("dim")
            .agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect())
    return np.array([r.low for r in rows]), np.array([r.high for r in rows])


def cells(vectors: DataFrame, width: int, bits: int, sample_rows: int):
    """Lower and upper edge of every cell, as (width, 2^bits) integer arrays;
    cell j holds the integers from its lower to its upper edge."""
    low, high = extremes(vectors, width)
    sample = (vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vec")).toArrow()
    parts = [padded(c, width, np.int64) for c in sample.column("vec").chunks if len(c)]
    points = np.concatenate(parts) if parts else np.zeros((1, width), np.int64)
    share = np.linspace(0, 1, (1 << bits) + 1)[1:-1]
    inner = np.quantile(points, share, axis=0, method="lower").astype(np.int64).T  # first integer of a cell
    lower = np.concatenate([low[:, None], np.maximum(inner, low[:, None])], 1)
    upper = np.concatenate([np.maximum(inner - 1, low[:, None]), high[:, None]], 1)
    return lower, np.maximum(upper, lower), inner


def top_k(vectors: DataFrame, is_query, k: int, id_col: str = "vec_id", vec_col: str = "vec",
          bits: int = CELL_BITS, query_tile: int = QUERY_TILE, candidate_tile: int = CANDIDATE_TILE,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The k best candidates of every row for which ``is_query(id column)``
    holds: query_id, rank, vec_id, score.  ``vec_col`` holds integer vectors."""
    spark = vectors.sparkSession
    named = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"))
    exact = materialize(one_per_id(named), "va_vectors")
    said = exact.agg(F.count("*"), F.count_if(is_query(F.col("vec_id"))), F.max(F.size("vec"))).first()
    n, n_queries, width = said[0], said[1], said[2] or 1
    if not n_queries or n < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    lower, upper, inner = cells(exact, width, bits, sample_rows)
    centre, half = (lower + upper) / 2.0, (upper - lower) / 2.0
    largest = np.maximum(np.abs(lower.astype(float)).max(1), np.abs(upper.astype(float)).max(1))

    def approximate(vec):
        m = padded(vec, width, np.int64)
        return np.stack([np.searchsorted(inner[j], m[:, j], side="right") for j in range(width)], 1).astype(np.uint8)

    def scan(batches):
        dims = np.arange(width)
        for batch in batches:
            for q_ids, queries, c_ids, codes in pair_arrays(batch, np.int64, np.uint8):
                middle, spread = centre[dims, codes].T.copy(), half[dims, codes].T.copy()
                for at in range(0, len(q_ids), 128):
                    q = queries[at: at + 128].astype(float)
                    ids = q_ids[at: at + 128]
                    near, far = q @ middle, np.abs(q) @ spread
                    far += 1e-12 * (np.abs(q) @ largest)[:, None]  # rounding of large products
                    own = ids[:, None] == c_ids[None, :]
                    low, high = np.where(own, -np.inf, near - far), np.where(own, -np.inf, near + far)
                    floor = np.full(len(ids), -np.inf)
                    if len(c_ids) > k:
                        floor = np.partition(low, len(c_ids) - k, axis=1)[:, len(c_ids) - k]
                    row, col = np.nonzero((high >= floor[:, None]) & ~own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[row]), pa.array(c_ids[col]), pa.array(low[row, col]), pa.array(high[row, col])],
                        names=["query_id", "vec_id", "lower", "upper"])

    queries = exact.filter(is_query(F.col("vec_id")))
    q_tiles, c_tiles = n_tiles(n_queries, query_tile), n_tiles(n, candidate_tile)
    pairs = tile_pairs(tiles(queries, q_tiles, lambda v: padded(v, width, np.int64)), q_tiles,
                       tiles(exact, c_tiles, approximate), c_tiles)
    by_lower = Window.partitionBy("query_id").orderBy(F.desc("lower"), "vec_id")
    by_upper = Window.partitionBy("query_id").orderBy(F.desc("upper"), "vec_id")
    whole = Window.partitionBy("query_id")
    kth = F.max(F.when(F.col("place") == k, F.col("lower"))).over(whole)
    kept = (pairs.mapInArrow(scan, SURVIVORS)
            .withColumn("place", F.row_number().over(by_lower)).withColumn("kth", kth)
            .filter(F.col("kth").isNull() | (F.col("upper") >= F.col("kth")))
            .select("query_id", "vec_id", "upper", F.row_number().over(by_upper).alias("turn")))
    kept = materialize(kept, "va_candidates")
    first = materialize(_read(kept.filter(F.col("turn") <= k), exact, queries), "va_first")
    bar = first.groupBy("query_id").agg(F.min("score").alias("bar"))
    later = kept.filter(F.col("turn") > k).join(bar, "query_id").filter(F.col("upper") >= F.col("bar"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (first.unionByName(_read(later, exact, queries))
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _read(pairs: DataFrame, exact: DataFrame, queries: DataFrame) -> DataFrame:
    """Exact scores of (query_id, vec_id) pairs."""
    product = F.zip_with("vec", "q_vec", lambda a, b: F.try_multiply(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))))
    score = F.aggregate(product, F.lit(0).cast("long"), lambda s, x: F.try_add(s, x))
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("q_vec"))
    return (pairs.select("query_id", "vec_id").join(exact, "vec_id").join(asked, "query_id")
            .select("query_id", "vec_id", score.alias("score")).filter(F.col("score").isNotNull()))


def scaled(embeddings: DataFrame, factor: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Usable vectors with every component x as floor(factor * x)."""
    v = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    return v.filter(finite(F.col("vec"))).select(
        "vec_id", F.transform("vec", lambda x: F.floor(x.cast("double") * factor)).alias("vec"))
