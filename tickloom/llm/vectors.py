"""Vector tables in bounded tiles: what both searches share.

Queries and candidates are dealt into tiles of a fixed number of vectors by a
hash of their id; every pair of a query tile and a candidate tile is one row of
work.  A task holds one such pair at a time, whatever the table's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ceil_div

PACKED = "tile int, n int, ids binary, matrix binary"


def finite(vec: Column) -> Column:
    """The vector has components and none is null or non-finite."""
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                  & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vec.isNotNull() & (F.size(vec) > 0) & ok


def one_per_id(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec) with one row per id: repeated rows count once, of several
    vectors under one id the largest stays; rows without an id take no part."""
    return (vectors.filter(F.col("vec_id").isNotNull())
            .groupBy("vec_id").agg(F.max("vec").alias("vec")))


def padded(values: pa.Array, width: int, dtype) -> np.ndarray:
    """A list array as a matrix; shorter vectors are filled with zeros."""
    size = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    if (size == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(size), width), dtype)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def tiles(vectors: DataFrame, n_tiles: int, encode) -> DataFrame:
    """One row per tile: ids and the matrix ``encode(list array)`` as bytes."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("vec_id")
        vec = table.column("vec").combine_chunks()
        if isinstance(vec, pa.ChunkedArray):
            vec = pa.concat_arrays(vec.chunks)
        ids = table.column("vec_id").to_numpy().astype(np.int64)
        return pa.table({"tile": pa.array([table.column("tile")[0].as_py()], pa.int32()),
                         "n": pa.array([len(ids)], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
                         "matrix": pa.array([np.ascontiguousarray(encode(vec)).tobytes()], pa.binary())})

    return (vectors.withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.lit(n_tiles)).cast("int"))
            .select("tile", "vec_id", "vec").groupBy("tile").applyInArrow(pack, PACKED))


def tile_pairs(queries: DataFrame, n_queries: int, candidates: DataFrame, n_candidates: int) -> DataFrame:
    """Every query tile beside every candidate tile, both sides dealt by the
    pair of tile numbers: an equi-join, no cross join."""
    tasks = n_queries * n_candidates
    q = queries.select(F.col("tile").alias("q"), F.col("n").alias("q_n"), F.col("ids").alias("q_ids"),
                       F.col("matrix").alias("q_matrix"),
                       F.explode(F.sequence(F.lit(0), F.lit(n_candidates - 1))).alias("c"))
    c = candidates.select(F.col("tile").alias("c"), F.col("n").alias("c_n"), F.col("ids").alias("c_ids"),
                          F.col("matrix").alias("c_matrix"),
                          F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("q"))
    return q.repartition(tasks, "q", "c").join(c.repartition(tasks, "q", "c"), ["q", "c"])


def pair_arrays(batch: pa.RecordBatch, q_type, c_type):
    """(query ids, query matrix, candidate ids, candidate matrix) of each row."""
    cols = {name: batch.column(name) for name in batch.schema.names}
    for i in range(batch.num_rows):
        q_n, c_n = cols["q_n"][i].as_py(), cols["c_n"][i].as_py()
        yield (np.frombuffer(cols["q_ids"][i].as_buffer(), np.int64),
               np.frombuffer(cols["q_matrix"][i].as_buffer(), q_type).reshape(q_n, -1),
               np.frombuffer(cols["c_ids"][i].as_buffer(), np.int64),
               np.frombuffer(cols["c_matrix"][i].as_buffer(), c_type).reshape(c_n, -1))


def n_tiles(rows: int, size: int) -> int:
    return ceil_div(rows, size)
