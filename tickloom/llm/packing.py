"""Best-fit packing of tokenised documents into fixed-length sequences.

Bounded-space online best fit: a fixed number of bins is open; a bitset keyed
by free space finds the open bin that a piece fills best; when no open bin has
room and all are in use, the fullest closes first.  Pieces arrive longest
first.

Only (doc_id, piece, length, crc) rows are shuffled, never ids: pieces are dealt
by hash to tasks of about ``pieces_per_task`` pieces, each task packs its own
sequences in one streaming pass that holds the open bins alone.  A lost
executor's task repeats with the same order and gives the same sequences.

Defined cases: a null text is an empty document (one piece, the end id); rows
that repeat a doc_id are packed as rows of their own; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import cached, ceil_div, materialize, text_slices, texts_of
from tickloom.llm.tokens import REMEMBERED, LibraryEncoder, with_end

CAPACITY = 1024
END_ID = 2
OPEN_BINS = 65_536
PIECES_PER_TASK = 131_072

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


def cut_points(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: one if it fits; else full pieces
    behind a shorter first one that takes the remainder."""
    head = n_tokens % capacity or min(n_tokens, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n_tokens, capacity)]


def token_pieces(docs: DataFrame, tokenizer_path: str, separator: str, end_id: int = END_ID,
                 capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                 remembered: int = REMEMBERED) -> DataFrame:
    """Tokenise whole texts, append ``end_id`` and cut what is longer than
    ``capacity``; one row per piece."""

    def run(batches):
        enc = cached(("library", tokenizer_path, remembered),
                     lambda: LibraryEncoder(tokenizer_path, separator, True, remembered))
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, off = with_end(*enc.encode(texts_of(part, "text")), end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                rows = [(row, i, s, m, zlib.crc32(raw[4 * (a + s): 4 * (a + s + m)]))
                        for row, (a, n) in enumerate(zip(off[:-1].tolist(), np.diff(off).tolist()))
                        for i, (s, m) in enumerate(cut_points(n, capacity))]
                row, piece, start, length, crc = map(np.array, zip(*rows))
                del ids, raw
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, PIECE_SCHEMA))


class OpenBins:
    """The open bins of one task: lists of sequence numbers by free space and a
    bitset of the free spaces that occur."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(sequence number, offset) of a piece."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.open >= self.most:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Give every piece a sequence and a gapless offset in it."""
    pieces = materialize(pieces, "pieces")
    n = pieces.count()

    def run(batches):
        bins, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            number, offset = zip(*map(bins.place, batch.column("length").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(number, np.int64) + base), pa.array(np.array(offset, np.int64))],
                names=[*batch.schema.names, "sequence_id", "offset"])

    dealt = pieces.repartition(ceil_div(n, pieces_per_task), F.xxhash64("doc_id", "piece", "ids_crc32"))
    return (dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
            .mapInArrow(run, PACKED_SCHEMA))
