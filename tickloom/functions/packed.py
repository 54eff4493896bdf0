"""Rows that cross an exchange once, in compressed Arrow blocks.

A shuffled row takes eight bytes and more a field, and repeats of a value cost a few
bytes each; the columns of some hundred rows compress to a third of that.  Rows are
dealt into parts by a hash of their keys, a task sends each part of the rows it has
gathered as one block, and a part is worked on as a whole.  A part is bounded in rows,
so there are more parts, not larger ones, as the input grows.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.functions.wide import first_rows

#: Rows a task gathers before it sends them.
PACK_ROWS = 1 << 18
#: Rows of a part.
PART_ROWS = 1 << 18
BLOCK = [T.StructField("_kind", T.IntegerType()), T.StructField("_size", T.LongType()), T.StructField("_block", T.BinaryType())]


def parts(spark, rows: int) -> int:
    """The number of parts for ``rows`` rows."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def part_of(n: int, *keys):
    """The part, one of ``n``, of a row."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int").alias("_part")


def payload(df: DataFrame, by: str = "_part") -> pa.Schema:
    """The Arrow schema of what a block of ``df`` holds: its columns but ``by``."""
    return nullable(df.drop(by))


def nullable(df: DataFrame) -> pa.Schema:
    return pa.schema([f.with_nullable(True) for f in to_arrow_schema(df.schema)])


def pack(df: DataFrame, by: str = "_part", kind: int = 0, combine=None) -> DataFrame:
    """``(by, _kind, _size, _block)``: the rows of ``df`` with one value of ``by``
    that a task has gathered, as one block.  ``combine`` takes and gives a table of
    all rows gathered; it may join rows of one value of ``by``."""
    gathered, inner = nullable(df), payload(df, by)
    schema = T.StructType([df.schema[by], *BLOCK])
    outer = to_arrow_schema(schema)

    def sent(held):
        table = pa.Table.from_batches(held).cast(gathered)
        table = table if combine is None else combine(table)
        table = table.take(pc.sort_indices(table, sort_keys=[(by, "ascending")])).combine_chunks()  # stable
        starts = first_rows(table, [by])
        rows = table.select(inner.names).to_batches()[0]
        codec, sizes, blocks = pa.Codec("zstd", compression_level=3), [], []
        for a, b in zip(starts, [*starts[1:], table.num_rows]):
            block = rows.slice(a, b - a).serialize()
            sizes.append(block.size)
            blocks.append(codec.compress(block, asbytes=True))
        return pa.RecordBatch.from_arrays([table.column(by).take(pa.array(starts)).combine_chunks().cast(outer.field(by).type),
                                           pa.array([kind] * len(blocks), pa.int32()), pa.array(sizes, pa.int64()),
                                           pa.array(blocks, pa.binary())], schema=outer)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= PACK_ROWS:
                yield sent(held)
                held, size = [], 0
        if held:
            yield sent(held)

    return df.mapInArrow(run, schema)


class Gathered:
    """The rows of a part that came so far; ``combine`` joins them when they get many."""

    def __init__(self, schema: pa.Schema, combine=None):
        self.schema, self.combine = schema, combine
        self.batches, self.rows, self.due = [], 0, 2 * PART_ROWS

    def add(self, size: int, block):
        raw = pa.decompress(block, decompressed_size=size, codec="zstd")
        self.batches.append(pa.ipc.read_record_batch(raw, self.schema))
        self.rows += self.batches[-1].num_rows
        if self.combine is not None and self.rows >= self.due:
            table = self.table()
            self.batches, self.rows = table.to_batches(), table.num_rows
            self.due = 2 * max(PART_ROWS, self.rows)

    def table(self) -> pa.Table:
        table = pa.Table.from_batches(self.batches, self.schema)
        return table if self.combine is None or not table.num_rows else self.combine(table)


def by_part(blocks: DataFrame, n: int, kinds, compute, schema: T.StructType) -> DataFrame:
    """What ``compute`` makes of each of the ``n`` parts of the packed ``blocks``: it
    takes a table for each of ``kinds``, their ``(payload, combine)``, and yields
    tables of ``schema``.  Blocks cross one exchange, a part is one task."""
    def run(batches):
        held = [Gathered(*k) for k in kinds]
        for batch in batches:
            for kind, size, block in zip(*(batch.column(c) for c in ("_kind", "_size", "_block"))):
                held[kind.as_py()].add(size.as_py(), block.as_buffer())
        for table in compute(*[g.table() for g in held]):
            yield from table.to_batches(10_000)

    return blocks.select("_part", *[f.name for f in BLOCK]).repartitionById(n, "_part").mapInArrow(run, schema)
