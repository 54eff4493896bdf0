"""Periodic runs of words, by block convolution at dyadic scales.

Words are maximal runs of bytes other than space and \\x09 to \\x0D.  A run is a
stretch of consecutive words with smallest period q (words q apart are equal),
at least ``min_copies`` * q and ``min_length`` words long, that no neighbouring
word extends.

Method.  Scale B = 1, 2, 4, ... finds the periods d in [B, 2B).  A run of such a
period holds a whole aligned block of B words that occurs again d words later.
  1. For every block the sums of squared differences to the following window, at
     all B distances at once, are one cyclic convolution of length 2B: an exact
     integer number-theoretic transform modulo a prime.  Words enter as random
     residues, so a distance whose sum is zero is an occurrence of the block
     unless the prime divides a non-zero sum; every occurrence is compared word
     by word before it is used.
  2. Blocks that follow each other at one distance chain up.  A chain that can
     reach min_copies * d words is extended word by word, by less than a block
     on either side, to a maximal stretch.
  3. An occurrence inside a run of a smaller scale, at a multiple of its period,
     is that run again and is left out; so every period kept is the smallest.
Two exact filters keep the transforms rare: a block takes part only if each
of its words occurs again within 2B words, and not where it and its window lie
in a run of a smaller scale.

Texts are worked off in slices of bounded size, side by side with a word
between them that equals no other; memory follows the longest text.  Work is
O(n log^2 n) for a slice of n words at worst.

Defined cases: a null or empty text has no words, no runs and an empty
collapsed text; a null doc_id is passed through; repeated rows are documents of
their own; an empty table gives no rows; other columns are passed through where
the caller keeps them (clashing names: choose the output names).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tickloom.llm.common import bytes_of, ragged, spare, text_slices, texts_of
from tickloom.llm.wordhash import white_space, word_spans

MIN_LENGTH, MIN_COPIES = 6, 4
PRIME, GENERATOR = 2013265921, 31  # 15 * 2^27 + 1
WORK_WORDS = 1 << 18               # words of transforms and comparisons held at once
SLICE_BYTES = 1 << 20

RUN = "struct<start:long,length:long,period:long>"


def word_numbers(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words, by comparing the words themselves."""
    if not len(starts):
        return np.zeros(0, np.int64)
    size = ends - starts
    data = raw[ragged(starts, size)]
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(data)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def roots(size: int) -> np.ndarray:
    """The first half of the powers of a size-th root of unity."""
    out = np.ones(max(size // 2, 1), np.int64)
    step, have = pow(GENERATOR, (PRIME - 1) // size, PRIME), 1
    while have < len(out):
        out[have: 2 * have] = out[:have] * pow(step, have, PRIME) % PRIME
        have *= 2
    return out


def transform(rows: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every row, result in bit-reversed order."""
    n, size = rows.shape
    half, stride = size // 2, 1
    while half:
        v = rows.reshape(n, -1, 2, half)
        a, b = v[:, :, 0], v[:, :, 1]
        out = np.empty_like(v)
        out[:, :, 0] = (a + b) % PRIME
        out[:, :, 1] = (a - b) % PRIME * power[::stride][:half] % PRIME
        rows, half, stride = out.reshape(n, size), half // 2, stride * 2
    return rows


def inverse(rows: np.ndarray, power: np.ndarray) -> np.ndarray:
    """The rows whose transforms (bit-reversed) these are."""
    n, size = rows.shape
    back = np.concatenate([power[:1], PRIME - power[:0:-1]]) if size > 2 else power  # inverse roots
    half = 1
    while half < size:
        v = rows.reshape(n, -1, 2, half)
        a, b = v[:, :, 0], v[:, :, 1] * back[::size // (2 * half)][:half] % PRIME
        out = np.empty_like(v)
        out[:, :, 0] = (a + b) % PRIME
        out[:, :, 1] = (a - b) % PRIME
        rows, half = out.reshape(n, size), half * 2
    return rows * pow(size, -1, PRIME) % PRIME


def zero_distances(x: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of every block of ``size`` words whose sum of
    squared differences to the words d further on is zero, d in [size, 2 size).
    ``x`` holds residues and is padded by 3 * size unlike ones."""
    power = roots(2 * size)
    found = [], []
    for at in range(0, len(blocks), max(1, WORK_WORDS // size)):
        s = blocks[at: at + max(1, WORK_WORDS // size)]
        block = x[s[:, None] + np.arange(size)]
        window = x[s[:, None] + size + np.arange(2 * size)]
        flipped = np.zeros((len(s), 2 * size), np.int64)
        flipped[:, :size] = block[:, ::-1]
        both = transform(flipped, power) * transform(window, power) % PRIME
        product = inverse(both, power)[:, size - 1: 2 * size - 1]
        squares = np.zeros((len(s), 2 * size + 1), np.int64)
        np.cumsum(window * window % PRIME, axis=1, out=squares[:, 1:])
        own = (block * block % PRIME).sum(1)
        total = (own[:, None] + squares[:, size: 2 * size] - squares[:, :size] - 2 * product) % PRIME
        row, lag = np.nonzero(total == 0)
        found[0].append(s[row])
        found[1].append(lag + size)
    return np.concatenate(found[0]), np.concatenate(found[1])


def inside(known: list, start: np.ndarray, end: np.ndarray, distance: np.ndarray | None) -> np.ndarray:
    """Whether [start, end) lies in a run of a smaller scale whose period divides
    ``distance`` (any period if None).  Of one scale's runs at most one holds
    so long an interval: the last that begins at or before it."""
    out = np.zeros(len(start), bool)
    for s, e, q in known:
        k = np.searchsorted(s, start, side="right") - 1
        hit = (k >= 0) & (e[k] >= end)
        if distance is not None:
            hit &= distance % q[k] == 0
        out |= hit
    return out


def equal_spans(x: np.ndarray, start: np.ndarray, distance: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` words from each start equal those ``distance`` later."""
    out = np.empty(len(start), bool)
    step = max(1, WORK_WORDS // size)
    for at in range(0, len(start), step):
        place = start[at: at + step, None] + np.arange(size)
        out[at: at + step] = (x[place] == x[place + distance[at: at + step, None]]).all(1)
    return out


def agreeing(x: np.ndarray, start: np.ndarray, distance: np.ndarray, limit: int, step: int) -> np.ndarray:
    """Number of consecutive words, below ``limit``, from each start in
    direction ``step`` that equal the word ``distance`` later."""
    out = np.empty(len(start), np.int64)
    chunk = max(1, WORK_WORDS // limit)
    for at in range(0, len(start), chunk):
        place = np.maximum(start[at: at + chunk, None] + step * np.arange(limit), 0)  # place 0 holds the border
        same = x[place] == x[place + distance[at: at + chunk, None]]
        same[:, -1] = False
        out[at: at + chunk] = same.argmin(1)
    return out


def find_runs(numbers: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, min_copies: int = MIN_COPIES):
    """(text, start, length, period) of all runs of many texts, ordered by text,
    start and period.  Text i holds the word numbers first[i] to first[i + 1]."""
    n_texts, n = len(first) - 1, len(numbers)
    count = np.diff(first)
    longest = int(count.max(initial=0))
    if min_copies < 3:
        raise ValueError("a block of every run recurs only from three copies on")
    none = np.zeros(0, np.int64)
    if longest < max(min_length, min_copies):
        return none, none, none, none
    scales = int(longest // min_copies).bit_length()
    pad = 3 << scales
    if 4 << scales > 1 << 27:
        raise ValueError("a text of more than 2^26 words")
    # One border word before every text and many after the last, unlike all others.
    base = first[:-1] + np.arange(n_texts) + 1
    length = n + n_texts + 1
    x = np.arange(length + pad, dtype=np.int64) + (numbers.max(initial=0) + 1)
    x[ragged(base, count)] = numbers
    order = np.argsort(x, kind="stable")
    again = np.full(len(x), len(x), np.int64)  # distance to the word's next occurrence
    same = x[order[1:]] == x[order[:-1]]
    again[order[:-1][same]] = np.diff(order)[same]
    values, place = np.unique(x, return_inverse=True)
    residues = np.random.default_rng(len(values)).integers(0, PRIME, len(values))[place]
    reach = again[:length]
    known: list = []
    found = []
    for scale in range(scales):
        size = 1 << scale
        if scale:  # farthest next occurrence among a block's words
            if len(reach) % 2:
                reach = np.append(reach, len(x))
            reach = np.maximum(reach[::2], reach[1::2])
        start = np.flatnonzero(reach < 2 * size) * size
        start = start[~inside(known, start, start + 3 * size, None)]
        if not len(start):
            continue
        start, d = zero_distances(residues, start, size)
        new = ~inside(known, start, start + d + size, d)
        start, d = start[new], d[new]
        good = equal_spans(x, start, d, size)
        order = np.lexsort((start[good], d[good]))
        start, d = start[good][order], d[good][order]
        if not len(start):
            continue
        head = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (start[1:] != start[:-1] + size)]))
        low, d = start[head], d[head]
        high = low + np.diff(head, append=len(start)) * size
        wide = high - low + 2 * (size - 1) >= (min_copies - 1) * d
        low, high, d = low[wide], high[wide], d[wide]
        low = low - agreeing(x, low - 1, d, size, -1)
        high = high + agreeing(x, high, d, size, 1) + d
        whole = high - low >= min_copies * d
        low, high, d = low[whole], high[whole], d[whole]
        if len(low):
            order = np.argsort(low, kind="stable")
            known.append((low[order], high[order], d[order]))
            found.append(known[-1])
    if not found:
        return none, none, none, none
    low, high, d = (np.concatenate(c) for c in zip(*found))
    keep = high - low >= min_length
    low, high, d = low[keep], high[keep], d[keep]
    text = np.searchsorted(base, low, side="right") - 1
    order = np.lexsort((d, low))
    return text[order], (low - base[text])[order], (high - low)[order], d[order]


def strongest(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> int:
    """The run of greatest length / period, compared exactly; ties go to the
    earlier one (runs come by start and period)."""
    best = 0
    for i, (n, q) in enumerate(zip(length.tolist(), period.tolist())):
        if n * int(period[best]) > int(length[best]) * q:
            best = i
    return best


def with_runs(docs: DataFrame, text_col: str = "text", keep=None, runs_col: str = "runs",
              strongest_col: str = "strongest", collapsed_col: str = "collapsed",
              min_length: int = MIN_LENGTH, min_copies: int = MIN_COPIES,
              slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with every text's runs
    in order of start and period, its run of greatest exponent (null if none),
    and the words that no run holds after its first period, joined by one space."""
    kept = [i for i, c in enumerate(docs.columns) if keep is None or c in keep]
    schema = StructType([*[docs.schema.fields[i] for i in kept], *StructType.fromDDL(
        f"`{runs_col}` array<{RUN}>, `{strongest_col}` {RUN}, `{collapsed_col}` string").fields])
    names = schema.fieldNames()
    at = docs.columns.index(text_col)
    separator = white_space()

    def run(batches):
        for batch in batches:
            batch = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in text_slices(batch, f"c{at}", slice_bytes):
                raw, off = bytes_of(texts_of(part, f"c{at}"))
                starts, ends, first = word_spans(raw, off, separator)
                text, low, length, period = find_runs(word_numbers(raw, starts, ends), first, min_length, min_copies)
                cut = np.searchsorted(text, np.arange(part.num_rows + 1))
                fields = [pa.array(c) for c in (low, length, period)]
                runs = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                top = pa.array([int(a + strongest(low[a:b], length[a:b], period[a:b])) if b > a else None
                                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())], pa.int64())
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, first[text] + low + period, 1)
                np.add.at(edge, first[text] + low + length, -1)
                stays = np.cumsum(edge[:-1]) == 0
                size = (ends - starts + 1)[stays]
                joined = np.append(raw, np.uint8(32))[ragged(starts[stays], size)]
                stop = np.concatenate([[0], np.cumsum(size)])
                joined[stop[1:] - 1] = 32
                words = np.concatenate([[0], np.cumsum(stays)])[first]
                byte_at = stop[words]
                data = joined.tobytes()
                texts = [data[a: max(a, b - 1)].decode("utf-8")
                         for a, b in zip(byte_at[:-1].tolist(), byte_at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in kept], pa.ListArray.from_arrays(pa.array(cut, pa.int32()), runs),
                     runs.take(top), pa.array(texts, pa.string())], names=names)
            spare()

    return docs.mapInArrow(run, schema)
