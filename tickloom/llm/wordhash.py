"""Words of many texts as arrays: positions and 64-bit hashes, without a Python
object per word."""

from __future__ import annotations

import hashlib

import numpy as np

U64 = np.uint64
LONG = 256  # bytes of a span from which on it is digested
MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def white_space() -> np.ndarray:
    """Separator bytes: space and \\x09 to \\x0D."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def not_alphanumeric() -> np.ndarray:
    """Separator bytes: ASCII that is neither letter nor digit."""
    table = np.ones(256, bool)
    table[128:] = False
    for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
        table[a:b] = False
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others (splitmix finaliser)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def word_spans(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray):
    """First byte and end of every word, and each text's first word (n + 1
    entries); a text's border ends a word."""
    inside = ~separator[raw]
    begin, end = inside.copy(), inside.copy()
    if len(raw):
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edge = offsets[(offsets > 0) & (offsets < len(raw))]
        begin[edge] = inside[edge]
        end[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of every byte span; ``which`` picks one of two hashes.  Spans
    are mixed eight bytes at a time, every step a bijection of the state, so spans
    of one length up to eight bytes never collide; long spans are digested
    (BLAKE2b).  No bytes outside the spans are read."""
    n = len(starts)
    if not n:
        return np.zeros(0, U64)
    length = ends - starts
    out = mix(length.astype(U64) * U64(BASES[1 - which]) + U64(BASES[which]))
    long = np.flatnonzero(length > LONG)
    left = np.flatnonzero(length <= LONG)
    # Eight bytes from any place on, as one unaligned little-endian integer.
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    at = 0
    while len(left):
        rest = length[left] - at
        part = eight[starts[left] + at] & MASKS[np.minimum(rest, 8)]
        out[left] = mix(out[left] ^ part) + U64(BASES[which])
        left = left[rest > 8]
        at += 8
    for i in long.tolist():
        said = hashlib.blake2b(raw[starts[i]: ends[i]].tobytes(), digest_size=8, salt=bytes([which])).digest()
        out[i] = int.from_bytes(said, "little")
    return out


def digests(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit BLAKE2b digest of every byte span as two 64-bit columns."""
    blake = hashlib.blake2b
    said = b"".join([blake(data[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())])
    both = np.frombuffer(said, "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def run_hashes(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of every ``size`` consecutive words, by doubling; the result is
    shorter by size - 1 (empty if there are fewer words)."""
    salt = U64(BASES[1 - which])
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, covered, power, span = None, 0, words, 1
    while True:
        if size & span:
            tail = power[covered: covered + n]
            out = tail.copy() if out is None else mix(out * salt + tail)
            covered += span
        if covered == size:
            return out
        power = mix(power[:-span] * salt + power[span:])
        span *= 2
