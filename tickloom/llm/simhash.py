"""SimHash near-dedup with pivot distance tables.

Fingerprint: texts are lower-cased (A to Z), cut into words (runs of bytes other
than space and \\x09 to \\x0D) and shingles of consecutive words joined by a space,
repeats included; a text with fewer words is one shingle of all of them.  A bit is
one if it is set in over half the shingles' XXH64 hashes (seed 42).

Links: fingerprints that differ in at most ``max_bits`` bits.  Equal fingerprints
are one row from here on.
  1. Routing without loss: 64 bits in max_bits + 2 blocks; two fingerprints within
     the limit agree on two blocks at least, so each fingerprint goes to a bucket
     for every pair of blocks (15 for four bits; 21 equal bits to a bucket).
     Of buckets with the same members one is kept; a large one is cut into tiles
     that meet in pairs.
  2. A task precomputes its fingerprints' Hamming distances to many fixed
     reference fingerprints.  By the triangle inequality a pair cannot be closer
     than its largest coordinate difference: rows are sorted by the first
     distance, only a window of it is compared, and one pivot after the other
     discards pairs.
  3. Survivors are verified by counting the differing bits.  A task returns links
     that join its components, never all its pairs.
Components come from distributed label propagation over the links.

Defined cases: null and empty texts have the fingerprint zero and link like any
other; rows that repeat a doc_id count each by their own text; rows without a
doc_id link too but never name a component (null if it has no other member); an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bytes_of, materialize, ragged, spare, text_slices, texts_of
from tickloom.llm.components import connected_components
from tickloom.llm.wordhash import white_space, word_spans

SHINGLE, SEED, MAX_BITS = 4, 42, 4
PIVOTS = 32
TILE = 4096          # fingerprints of a bucket's tile
FEW = 16             # buckets up to this size are compared side by side
SLICE_BYTES = 1 << 20
COUNTED = 1 << 16    # shingles whose bits are counted at once
COMPARED = 1 << 20   # pairs compared at once


def fingerprints(texts: pa.Array, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The 64-bit fingerprint of every text."""
    raw, off = bytes_of(texts)
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 32
    starts, ends, first = word_spans(raw, off, white_space())
    count = np.diff(first)
    length = ends - starts + 1
    data = np.append(lower[raw], np.uint8(32))[ragged(starts, length)]
    stop = np.cumsum(length)
    begin = stop - length
    data[stop - 1] = 32
    data = data.tobytes()
    owner = np.repeat(np.arange(len(count)), count)
    at = np.arange(max(len(starts) - size + 1, 0))
    at = at[owner[at] == owner[at + size - 1]]
    short = np.flatnonzero((count > 0) & (count < size))
    text = np.concatenate([owner[at], short])
    low = np.concatenate([begin[at], begin[first[short]]])
    high = np.concatenate([stop[at + size - 1], stop[first[short + 1] - 1]]) - 1
    order = np.argsort(text, kind="stable")
    text, low, high = text[order], low[order], high[order]
    ones = np.zeros((len(count), 64), np.int64)
    for a in range(0, len(text), COUNTED):
        pairs = zip(low[a: a + COUNTED].tolist(), high[a: a + COUNTED].tolist())
        here = text[a: a + COUNTED]
        h = np.fromiter((xxhash.xxh64_intdigest(data[x:y], seed) for x, y in pairs), np.uint64, len(here))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        head = np.flatnonzero(np.diff(here, prepend=-1))
        ones[here[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int64)
    shingles = np.bincount(text, minlength=len(count))
    return np.packbits(2 * ones > shingles[:, None], axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                      size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, print) of every row, the fingerprint's bits as a signed long."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                prints = fingerprints(texts_of(part, "text"), size, seed)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints.view(np.int64))],
                                                 names=["doc_id", "print"])
            spare()

    return named.mapInArrow(run, "doc_id long, print long")


def block_masks(max_bits: int) -> list[int]:
    """Signed 64-bit masks of every pair of max_bits + 2 blocks of bits."""
    n = max_bits + 2
    edge = [64 * i // n for i in range(n + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edge[:-1], edge[1:])]
    pairs = [block[i] | block[j] for i in range(n) for j in range(i + 1, n)]
    return [m - (1 << 64) if m >> 63 else m for m in pairs]


def pivot_distances(prints: np.ndarray, pivots: int) -> np.ndarray:
    """Hamming distances to the reference fingerprints, one row per pivot."""
    refs = np.random.default_rng(pivots).integers(0, 1 << 64, pivots, dtype=np.uint64, endpoint=False)
    return np.stack([np.bitwise_count(prints ^ r) for r in refs]).astype(np.int8)


def survivors(a: np.ndarray, b: np.ndarray, table: np.ndarray, max_bits: int):
    """The pairs (a, b) that no pivot discards."""
    for row in table:
        keep = np.abs(row[a] - row[b]) <= max_bits
        a, b = a[keep], b[keep]
        if not len(a):
            break
    return a, b


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of every pair (a, b) in place; a label is the
    smallest member of its component."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def links_of(group: np.ndarray, side: np.ndarray, prints: np.ndarray, max_bits: int, pivots: int):
    """Links (row, row) that join the components of every group's rows.  A group
    with rows on sides 0 and 1 compares across them only; one with side 0 alone
    compares all its rows.  Groups are numbered in ascending order."""
    table = pivot_distances(prints, pivots)
    label = np.arange(len(prints))
    size = np.bincount(group)
    first = np.cumsum(size) - size
    across = np.bincount(group, side) > 0

    def verify(a, b):
        a, b = survivors(a, b, table, max_bits)
        near = np.bitwise_count(prints[a] ^ prints[b]) <= max_bits
        join_labels(label, a[near], b[near])

    small = np.flatnonzero(size[group] <= FEW)
    for lag in range(1, FEW):
        a = small[:-lag][group[small[lag:]] == group[small[:-lag]]] if len(small) > lag else small[:0]
        verify(a, a + lag)
    for g in np.flatnonzero(size > FEW):
        rows = np.arange(first[g], first[g] + size[g])
        rows = rows[np.argsort(table[0, rows], kind="stable")]
        left, right = (rows[side[rows] == 0], rows[side[rows] == 1]) if across[g] else (rows, rows)
        near = table[0, right].astype(np.int64)
        low = np.searchsorted(near, table[0, left].astype(np.int64) - max_bits)
        high = np.searchsorted(near, table[0, left].astype(np.int64) + max_bits, side="right")
        if not across[g]:
            low = np.arange(len(left)) + 1  # each pair once
        width = np.maximum(high - low, 0)
        at, done = 0, np.concatenate([[0], np.cumsum(width)])
        while at < len(left):
            stop = max(at + 1, int(np.searchsorted(done, done[at] + COMPARED, side="right")) - 1)
            verify(np.repeat(left[at:stop], width[at:stop]), right[ragged(low[at:stop], width[at:stop])])
            at = stop
    other = np.flatnonzero(label != np.arange(len(label)))
    return label[other], other


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, pivots: int = PIVOTS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints (column print) at most
    ``max_bits`` bits apart."""
    masks = block_masks(max_bits)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    placed = prints.select("print", F.explode(keys).alias("bucket"))
    sizes = (placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("print").alias("low"),
                                          F.max("print").alias("high"),
                                          F.sum(F.xxhash64("print").cast("decimal(38,0)")).alias("set"))
             .filter("n > 1").groupBy("n", "low", "high", "set").agg(F.min("bucket").alias("bucket")))
    sizes = sizes.select("bucket", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    dealt = placed.join(sizes, "bucket").withColumn("mine", F.pmod(F.xxhash64("print", F.lit(1)), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    rows = dealt.select(F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("grp"),
                        (F.col("mine") > F.col("other")).cast("int").alias("side"), "print")
    rows = rows.repartition("grp").sortWithinPartitions("grp")

    def run(batches):
        def compare(table):
            grp, side, found = (table.column(c).to_numpy() for c in ("grp", "side", "print"))
            group = np.cumsum(np.concatenate([[0], grp[1:] != grp[:-1]]))
            a, b = links_of(group, side, found.view(np.uint64), max_bits, pivots)
            return pa.RecordBatch.from_arrays([pa.array(found[a]), pa.array(found[b])], names=["a", "b"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([*(held.to_batches() if held is not None else []), batch])
            grp = held.column("grp").to_numpy()
            whole = int(np.searchsorted(grp, grp[-1]))  # the last group may go on
            if whole:
                yield compare(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield compare(held)

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, size: int = SHINGLE, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text", pivots: int = PIVOTS,
                    tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the smallest
    doc_id that links reach) of every row."""
    signed = materialize(with_fingerprints(docs, text_col, id_col, size, seed), "simhash_prints")
    prints = materialize(signed.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash_distinct")
    labels = connected_components(materialize(near_links(prints, max_bits, pivots, tile), "simhash_links"))
    named = prints.join(labels, prints["print"] == labels["node"], "left").select(
        "print", "least", F.coalesce("component", "print").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = named.join(least, "component").select("print", "component_id")
    return signed.join(of_print, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
