"""Substring deduplication: words of windows that occurred before go.

A window is a fixed number of consecutive words; a window whose word sequence
also starts earlier (smaller doc_id, or earlier in the document) is a repeat, and every
word that a repeat covers is removed.

Method.  Documents are written once in blocks of bounded size.
  1. Each block adds its windows to a count-min sketch, cut into shards by
     window hash; a block sends, per shard and sketch row, the sorted cells it
     touches (delta-coded, about ten bits a window).  A shard's task merges the
     blocks' cells by adding, and answers each block with one bit per cell it
     sent: whether the merged count is two or more.  Counts only ever
     overestimate, so no repeat is lost.
  2. A block keeps the windows whose cells say "repeated" in every row (or
     that it holds twice itself) and sends their hashes, the 128-bit BLAKE2b
     digests of their words and their documents to the shards, which group them,
     find each window's earliest document and answer one bit per window.  Windows
     are one key only if the digests of their words agree, so the grouping is exact
     up to a collision of a cryptographic hash.
  3. A block removes the covered words.
Sketch width, shards and blocks grow with the input; a task holds one shard or
one block.  A window in a third of all documents is one entry per block.

Defined cases: a null text has no words; a text shorter than a window keeps all
its words; a null doc_id comes last; rows that repeat a doc_id are documents of
their own in stored order; an empty table gives no rows; other columns pass
through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.common import bytes_of, ceil_div, free_name, materialize, ragged, spare, text_slices, texts_of
from tickloom.llm.wordhash import U64, digests, mix, run_hashes, span_hashes, white_space, word_spans

WINDOW = 20
BLOCK_BYTES = 4 << 20
SHARD_WINDOWS = 1 << 19
CELLS_PER_WINDOW = 4
ROW_SALT = (0x632BE59BD9B4E019, 0xE220A8397B1DCDAF)  # one per sketch row
LAST = np.iinfo(np.int64).max

BLOCKS = "block long, n_windows long, payload binary"
CELLS = "shard int, block long, row_0 binary, row_1 binary"
SAID = "kind int, shard int, block long, row_0 binary, row_1 binary"
KEYS = "shard int, block long, keys binary"


def squeeze(columns: list[np.ndarray]) -> bytes:
    """Integer columns of one length, byte planes apart, compressed."""
    codec = pa.Codec("zstd", compression_level=1)
    out = [np.array([len(columns), len(columns[0])], "<i8").tobytes()]
    for c in columns:
        planes = np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T)
        packed = codec.compress(planes.tobytes(), asbytes=True)
        out += [np.array([planes.shape[0], len(packed)], "<i8").tobytes(), packed]
    return b"".join(out)


def unsqueeze(data: bytes, kinds: list) -> list[np.ndarray]:
    codec = pa.Codec("zstd")
    _, n = np.frombuffer(data, "<i8", 2)
    at, out = 16, []
    for kind in kinds:
        planes, size = np.frombuffer(data, "<i8", 2, at).tolist()
        raw = codec.decompress(data[at + 16: at + 16 + size], planes * int(n), asbytes=True)
        at += 16 + size
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(planes, -1).T).view(kind).ravel())
    return out


def deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def cut_blocks(docs: DataFrame, text_col: str, window: int, block_bytes: int) -> DataFrame:
    """Documents in blocks of about ``block_bytes`` of text (one document at
    least), each a compressed Arrow stream of all columns."""
    at = docs.columns.index(text_col)

    def run(batches):
        base, made = TaskContext.get().partitionId() << 32, 0
        held, size, windows = [], 0, 0

        def block():
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
            whole = pa.Table.from_batches(held).combine_chunks()
            with pa.ipc.new_stream(sink, whole.schema, options=options) as out:
                out.write_table(whole)
            return pa.RecordBatch.from_pydict(
                {"block": [base + made], "n_windows": [windows], "payload": [sink.getvalue().to_pybytes()]},
                schema=pa.schema([("block", pa.int64()), ("n_windows", pa.int64()), ("payload", pa.binary())]))

        for batch in batches:
            batch = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in text_slices(batch, f"c{at}", block_bytes // 4):
                raw, off = bytes_of(texts_of(part, f"c{at}"))
                first = word_spans(raw, off, white_space())[2]
                if held and size + len(raw) > block_bytes:
                    yield block()
                    held, size, windows, made = [], 0, 0, made + 1
                held.append(part)
                size += len(raw)
                windows += int(np.maximum(np.diff(first) - window + 1, 0).sum())
        if held:
            yield block()
        held = None
        spare()

    return docs.mapInArrow(run, BLOCKS)


class BlockWindows:
    """The windows of one block: distinct ones in hash order, with shards and
    sketch cells."""

    def __init__(self, payload: bytes, id_at: int, text_at: int, window: int, n_shards: int, width: int):
        self.docs = pa.ipc.open_stream(payload).read_all().combine_chunks()
        ids = self.docs.column(id_at).combine_chunks() if self.docs.num_rows else pa.array([], pa.int64())
        ids = pa.concat_arrays(ids.chunks) if isinstance(ids, pa.ChunkedArray) else ids
        ids = ids.cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)
        batch = self.docs.to_batches()[0]
        self.raw, self.offsets = bytes_of(texts_of(batch, batch.schema.names[text_at]))
        self.starts, self.ends, self.first = word_spans(self.raw, self.offsets, white_space())
        self.window, self.width = window, width
        n_docs = len(ids)
        rank = np.empty(n_docs, np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(n_docs)
        owner = np.repeat(np.arange(n_docs), np.diff(self.first))
        at = np.arange(max(len(self.starts) - window + 1, 0))
        at = at[owner[at] == owner[at + window - 1]]  # windows do not cross documents
        h = run_hashes(span_hashes(self.raw, self.starts, self.ends), window)[at]
        # By hash, then by document and place: the first of equals is the earliest.
        order = np.lexsort((at, rank[owner[at]], h))
        self.at, self.h, self.owner_id = at[order], h[order], ids[owner[at[order]]]
        self.fresh = np.flatnonzero(np.concatenate([[True], self.h[1:] != self.h[:-1]])) if len(h) else at
        self.distinct = self.h[self.fresh]
        self.twice = np.diff(self.fresh, append=len(self.h)) > 1
        shard = ((self.distinct >> U64(32)) * U64(n_shards)) >> U64(32)
        self.cut = np.searchsorted(shard, np.arange(n_shards + 1).astype(U64))

    def shards(self):
        for s, (a, b) in enumerate(zip(self.cut[:-1].tolist(), self.cut[1:].tolist())):
            if b > a:
                yield s, a, b

    def cells(self, a: int, b: int, row: int) -> np.ndarray:
        return (((mix(self.distinct[a:b] ^ U64(ROW_SALT[row])) >> U64(32)) * U64(self.width)) >> U64(32)).astype(np.uint32)

    def suspected(self, said: dict[int, tuple[bytes, bytes]]) -> np.ndarray:
        """Distinct windows estimated to occur twice or more."""
        out = self.twice.copy()
        for s, a, b in self.shards():
            flags = np.ones(b - a, bool)
            for row, data in enumerate(said[s]):
                order = np.argsort(self.cells(a, b, row), kind="stable")
                answer = np.empty(b - a, bool)
                answer[order] = unbits(data, b - a)
                flags &= answer
            out[a:b] |= flags
        return out

    def exact(self, suspected: np.ndarray):
        """The suspected windows' occurrences, grouped by hash and digest: their
        places, which is its key's first here, each one's key, and the hash, digest
        and document of every distinct key."""
        n = np.diff(self.fresh, append=len(self.h))
        rows = ragged(self.fresh[suspected], n[suspected])
        size = self.ends - self.starts + 1
        stop = np.cumsum(size)
        joined = np.append(self.raw, np.uint8(32))[ragged(self.starts, size)]
        joined[stop - 1] = 32  # words joined by one space
        a, b = digests(joined.tobytes(), (stop - size)[self.at[rows]], stop[self.at[rows] + self.window - 1])
        order = np.lexsort((np.arange(len(rows)), b, a, self.h[rows]))
        rows, a, b = rows[order], a[order], b[order]
        h = self.h[rows]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(rows) \
            else np.zeros(0, bool)
        head = np.flatnonzero(new)
        return rows, new, np.cumsum(new) - 1, h[head], a[head], b[head], self.owner_id[rows[head]]


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   kept_col: str = "kept", words_col: str = "n_words", removed_col: str = "n_removed",
                   block_bytes: int = BLOCK_BYTES, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """``docs`` with the kept words joined by one space, the number of words
    and how many of them were removed."""
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    clash = {c.lower() for c in docs.columns} & {c.lower() for c in (kept_col, words_col, removed_col)}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already: name the new ones otherwise")
    blocks = materialize(cut_blocks(docs, text_col, window, block_bytes), "dedup_blocks")
    total = blocks.agg(F.coalesce(F.sum("n_windows"), F.lit(0))).first()[0]
    n_shards = ceil_div(total, shard_windows)
    width = CELLS_PER_WINDOW * ceil_div(total, n_shards)

    def opened(payload):
        return BlockWindows(payload, id_at, text_at, window, n_shards, width)

    def sketch(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                w = opened(payload.as_buffer())
                out = [[], [], [], []]
                for s, a, b in w.shards():
                    for column, value in zip(out, (s, block, *(squeeze([deltas(np.sort(w.cells(a, b, r)))])
                                                               for r in (0, 1)))):
                        column.append(value)
                del w  # one block at a time
                spare()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()),
                     pa.array(out[3], pa.binary())], names=["shard", "block", "row_0", "row_1"])

    def merge(table: pa.Table) -> pa.Table:
        said = {}
        for row in ("row_0", "row_1"):
            cells = [np.cumsum(unsqueeze(x, [np.uint32])[0], dtype=np.int64) for x in table.column(row).to_pylist()]
            count = np.bincount(np.concatenate(cells), minlength=width)
            said[row] = pa.array([bits(count[c] > 1) for c in cells], pa.binary())
        return pa.table({"kind": pa.array(np.zeros(table.num_rows, np.int32)), "shard": table.column("shard"),
                         "block": table.column("block"), **said})

    estimated = materialize(blocks.mapInArrow(sketch, CELLS).groupBy("shard").applyInArrow(merge, SAID),
                            "dedup_estimates")

    def with_answers(answers: DataFrame) -> DataFrame:
        told = answers.groupBy("block").agg(F.collect_list(F.struct("kind", "shard", "row_0", "row_1")).alias("said"))
        return blocks.join(told, "block", "left").select("block", "payload", "said")

    def rows_of(batches):
        for batch in batches:
            for block, payload, said in zip(batch.column("block").to_pylist(), batch.column("payload"),
                                            batch.column("said").to_pylist()):
                by_kind: tuple[dict, dict] = ({}, {})
                for x in said or []:
                    by_kind[x["kind"]][x["shard"]] = (x["row_0"], x["row_1"])
                yield block, opened(payload.as_buffer()), by_kind
                spare()

    def key_cuts(h):
        return np.searchsorted(((h >> U64(32)) * U64(n_shards)) >> U64(32), np.arange(n_shards + 1).astype(U64)).tolist()

    def send(batches):
        for block, w, (estimates, _) in rows_of(batches):
            _, _, _, h, x, y, doc = w.exact(w.suspected(estimates))
            out = [[], [], []]
            cut = key_cuts(h)
            for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                if b > a:
                    for column, value in zip(out, (s, block, squeeze([deltas(h[a:b]), x[a:b], y[a:b], doc[a:b]]))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                names=["shard", "block", "keys"])
            del w, h, x, y, doc

    def group(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        parts = [unsqueeze(x, [np.uint64, np.uint64, np.uint64, np.int64]) for x in table.column("keys").to_pylist()]
        h = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        x, y, doc = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        order = np.lexsort((doc, y, x, h))  # stable: equal documents in block order
        earlier = np.zeros(len(order), bool)
        earlier[order[1:]] = (np.diff(h[order]) == 0) & (np.diff(x[order]) == 0) & (np.diff(y[order]) == 0)
        ends = np.cumsum([len(p[0]) for p in parts])
        said = [bits(earlier[e - len(p[0]): e]) for e, p in zip(ends, parts)]
        n = table.num_rows
        return pa.table({"kind": pa.array(np.ones(n, np.int32)), "shard": table.column("shard"),
                         "block": table.column("block"), "row_0": pa.array(said, pa.binary()),
                         "row_1": pa.array([b""] * n, pa.binary())})

    repeated = (with_answers(estimated).mapInArrow(send, KEYS).groupBy("shard").applyInArrow(group, SAID))
    out_schema = StructType([*docs.schema.fields, *StructType.fromDDL(
        f"`{kept_col}` string, `{words_col}` long, `{removed_col}` long").fields])
    names = out_schema.fieldNames()

    def remove(batches):
        for _, w, (estimates, answers) in rows_of(batches):
            rows, new, key, h, _, _, _ = w.exact(w.suspected(estimates))
            earlier = np.zeros(len(h), bool)
            cut = key_cuts(h)
            for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                if b > a:
                    earlier[a:b] = unbits(answers[s][0], b - a)
            gone = w.at[rows[~new | earlier[key]]]  # all but a key's very first occurrence
            edge = np.zeros(len(w.starts) + 1, np.int64)
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + window, -1)
            covered = np.cumsum(edge[:-1]) > 0
            keep = ~covered
            size = (w.ends - w.starts + 1)[keep]
            padded = np.append(w.raw, np.uint8(32))
            text = padded[ragged(w.starts[keep], size)]
            stop = np.cumsum(size)
            text[stop - 1] = 32
            n_words = np.diff(w.first)
            kept_before = np.concatenate([[0], np.cumsum(keep)])[w.first]
            byte_at = np.concatenate([[0], stop])[kept_before]
            n_kept = np.diff(kept_before)
            raw = text.tobytes()
            texts = [raw[a: max(a, b - 1)].decode("utf-8") for a, b in zip(byte_at[:-1].tolist(), byte_at[1:].tolist())]
            batch = w.docs.to_batches()[0]
            result = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array(n_words.astype(np.int64)),
                 pa.array((n_words - n_kept).astype(np.int64))], names=names)
            for at in range(0, result.num_rows, 2000):
                yield result.slice(at, 2000)
            del w, rows, new, key, h, gone, edge, covered, keep, padded, text, raw, texts, batch, result

    return with_answers(estimated.unionByName(repeated)).mapInArrow(remove, out_schema)


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the same columns; texts that lose words become their kept
    words joined by one space, all others stay as they are."""
    kept, words, removed = (free_name(docs, c) for c in ("kept_text", "words_in", "words_removed"))
    out = remove_repeats(docs, window, id_col, text_col, kept, words, removed)
    return out.select(*(F.when(F.col(removed) > 0, F.col(kept)).otherwise(F.col(c)).alias(c) if c == text_col
                        else F.col(c) for c in docs.columns))
