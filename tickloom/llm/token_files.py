"""Token-ID output: Parquet files with one list of ids per document.

Files are written by Spark's Parquet writer: ids in a list column with
dictionary pages (a vocabulary is small next to a row group), the document
number and the running position without dictionary, so that the format's second
version delta-encodes them, row groups and pages of a fixed size, and the page
indexes the writer adds.  A reader that wants few documents, or only the
metadata columns, skips the rest (``read_tokens``).

Documents are range-partitioned by id, so the files in name order hold ids in
ascending document order.  A document's position in the whole is its position
in its file plus the sum of the files before it; that sum comes from one row per
file, which is broadcast, so ids are read in place and a file can be many tasks.

Defined cases: a null text is an empty document (the end id alone); a null
doc_id sorts first; repeated rows are documents of their own, in text order; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import cached, text_slices, texts_of
from tickloom.llm.tokens import REMEMBERED, LibraryEncoder, with_end

FILE_SCHEMA = "file int, doc_id long, file_start long, n_tokens long, ids array<int>"
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000

WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#file_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, separator: str, end_id: int,
                 keeps_spaces: bool = False, id_col: str = "doc_id", text_col: str = "text",
                 row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
                 page_rows: int = PAGE_ROWS, remembered: int = REMEMBERED) -> None:
    """Tokenise whole texts, append ``end_id``, write in ascending id order."""

    def run(batches):
        enc = cached(("library", tokenizer_path, remembered),
                     lambda: LibraryEncoder(tokenizer_path, separator, keeps_spaces, remembered))
        file, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, off = with_end(*enc.encode(texts_of(part, "text")), end_id)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, file, np.int32)), part.column("doc_id"), pa.array(before + off[:-1]),
                     pa.array(np.diff(off)), pa.ListArray.from_arrays(off.astype(np.int32), ids.view(np.int32))],
                    names=["file", "doc_id", "file_start", "n_tokens", "ids"])
                before += int(off[-1])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = named.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"))
    (ordered.mapInArrow(run, FILE_SCHEMA).write.options(**WRITER)
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.page.row.count.limit", page_rows).parquet(path))


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None,
                with_ids: bool = True) -> DataFrame:
    """Documents of a token table: doc_id, start (ids of all documents before
    it), n_tokens and, unless left out, ids.  A range of doc_ids is pushed to
    the scan, where row-group statistics and page indexes skip the rest."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sums = files.groupBy(F.col("file").alias("in_file")).agg(F.sum("n_tokens").alias("total"))
    sums = sums.select("in_file", (F.sum("total").over(Window.orderBy("in_file")) - F.col("total")).alias("base"))
    if first is not None:
        files = files.filter(F.col("doc_id") >= first)
    if last is not None:
        files = files.filter(F.col("doc_id") <= last)
    rows = files.join(F.broadcast(sums), files["file"] == sums["in_file"])  # one row a file: ids stay where they are
    return rows.select("doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens",
                       *(["ids"] if with_ids else []))


def with_crc(rows: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Replace the ids by the crc32 of their little-endian 32-bit bytes."""

    def crc(batches):
        for batch in batches:
            lists = batch.column(ids_col)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            raw = memoryview(lists.flatten().to_numpy().astype("<i4").tobytes())
            ends = np.cumsum(sizes).tolist()
            sums = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip([0, *ends[:-1]], ends)]
            keep = [c for c in batch.schema.names if c != ids_col]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sums, pa.int64())],
                                             names=[*keep, "ids_crc32"])

    kept = [f"`{c}` {t}" for c, t in rows.dtypes if c != ids_col]
    return rows.mapInArrow(crc, ", ".join([*kept, "ids_crc32 long"]))
