"""Helpers shared by the text and vector operators."""

from __future__ import annotations

import ctypes
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import materialize  # noqa: F401  (re-used by every operator)

SLICE_BYTES = 4 << 20
SCORED_BYTES = 1 << 20  # where texts also travel back


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker process, so that a
    tokenizer or table is loaded once per worker and not once per task."""
    name = "_tickloom_llm_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def cached(key, make):
    """``make()`` once per worker process under ``key``."""
    cache = worker_cache()
    if key not in cache:
        cache[key] = make()
    return cache[key]


def spare() -> None:
    """Give memory that Arrow and the C library hold for later back to the system:
    a worker lives on through all stages, and so would what it holds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc
        trim(0)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Cut a record batch so that each slice holds at most ``limit`` bytes of
    ``column`` (one row at least, whatever its size): memory stays bounded by
    the longest single text, not by the batch."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The text column of a slice as plain strings, nulls as empty texts."""
    arr = batch.column(column)
    if not pa.types.is_string(arr.type):
        arr = arr.cast(pa.string())
    arr = pc.fill_null(arr, "")
    return arr if arr.offset == 0 else pa.concat_arrays([arr])


def bytes_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array without nulls, and its n + 1 offsets."""
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int32)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]] if len(arr) else raw[:0], off - (off[0] if len(arr) else 0)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of every run, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores added until no column of ``df`` has it
    (Spark compares names without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def text_crc_mod(col: Column, modulus: int) -> Column:
    """crc32 of the column's text, modulo ``modulus``."""
    return F.crc32(F.encode(col.cast("string"), "UTF-8")) % F.lit(modulus)


def ceil_div(n: int, size: int) -> int:
    return max(1, -(-n // size))


def append_columns(df: DataFrame, text_col: str, fields: str, start, keep=None) -> DataFrame:
    """``df`` with columns computed from its whole texts; the columns ``keep``
    (all by default) are passed through, others do not travel back.  ``start()``
    runs once per task and returns the function from a string array to the new
    columns' arrays."""
    from pyspark.sql.types import StructType
    kept = [i for i, c in enumerate(df.columns) if keep is None or c in keep]
    schema = StructType([*[df.schema.fields[i] for i in kept], *StructType.fromDDL(fields).fields])
    names = schema.fieldNames()
    clash = {c for c in names if [x.lower() for x in names].count(c.lower()) > 1}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already: name the new ones otherwise or keep fewer")
    at = df.columns.index(text_col)

    def run(batches):
        compute = start()
        for batch in batches:
            batch = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in text_slices(batch, f"c{at}", SCORED_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in kept], *compute(texts_of(part, f"c{at}"))], names=names)
        spare()

    return df.mapInArrow(run, schema)


def labelled(labels: DataFrame, label_col: str, wanted: Column, id_col: str = "doc_id") -> DataFrame:
    """A (doc_id, label) row of every labelled id for which ``wanted`` holds.
    Labels of one id are averaged; null labels and ids are skipped."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & wanted)
    return known.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))


def labelled_sample(labels: DataFrame, label_col: str, wanted: Column, max_rows: int,
                    id_col: str = "doc_id") -> DataFrame:
    """At most ``max_rows`` (doc_id, label) rows among those for which
    ``wanted`` holds, chosen by a hash of the id, so a larger table changes the
    choice but not its size."""
    one = labelled(labels, label_col, wanted, id_col)
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
