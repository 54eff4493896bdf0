"""Byte-level BPE encoding and decoding with batched numpy merge rounds.

The symbols of many words lie in one flat array.  A round looks up the key of
every neighbouring pair by binary search over the sorted pair keys, finds each
word's lowest-ranked pair, and merges its occurrences from left to right; words
without a known pair leave the array.  The vocabulary file's merges each make a
symbol of their own, so merging all occurrences of a word's best pair at once
equals merging them one by one.

Words are the matches of the byte-level split pattern; special strings of the
file in a text become their ids, as the library does.  Decoding concatenates the
bytes of the ids; bytes that are not UTF-8 become replacement characters; ids
outside the vocabulary give nothing.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import cached, ragged, text_slices, texts_of
from tickloom.llm.tokens import ChunkStore

#: The split pattern of byte-level BPE (fixed value, given with the vocabularies).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_WORD = 2048
NONE = np.iinfo(np.int64).max


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 characters
    for themselves, the other bytes for the characters from 256 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    chars, spare = [], 256
    for b in range(256):
        chars.append(chr(b) if b in own else chr(spare))
        spare += b not in own
    return chars


class Vocabulary:
    """The arrays of a byte-level BPE file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        self.byte_id = np.array([vocab[c] for c in alphabet], np.int64)
        self.size = 1 + max([*vocab.values(), *added.values()])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        to_byte = {c: b for b, c in enumerate(alphabet)}
        token = [b""] * self.size
        for t, i in vocab.items():
            token[i] = bytes(to_byte[c] for c in t) if all(c in to_byte for c in t) else t.encode()
        for t, i in added.items():
            token[i] = t.encode()
        self.added = added
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
        self.words = regex.compile(PATTERN).findall
        self.token_bytes, self.token_start, self.token_len = self._table(token)
        self.digits, self.digit_start, self.digit_len = self._table([b"%d," % i for i in range(self.size)])

    @staticmethod
    def _table(items: list[bytes]):
        length = np.array([len(t) for t in items], np.int64)
        return np.frombuffer(b"".join(items), np.uint8), np.cumsum(length) - length, length

    def pair_slots(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each pair key among the sorted ones, and whether it is there."""
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return at, self.keys[at] == key

    def merge_words(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as flat symbols with ``lengths`` (all positive)."""
        word = np.repeat(np.arange(len(lengths)), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            slot = np.zeros(len(symbols), np.int64)
            rank = np.full(len(symbols), NONE)
            inner = word[:-1] == word[1:]
            at, known = self.pair_slots(symbols[:-1] * self.size + symbols[1:])
            slot[:-1] = at
            rank[:-1] = np.where(inner & known, self.rank[at], NONE)
            starts = np.flatnonzero(np.concatenate([[True], ~inner]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(starts, append=len(symbols))
            each = np.repeat(best, sizes)
            if (best == NONE).any():
                over = each == NONE
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                stay = ~over
                symbols, word, slot, rank, each = (x[stay] for x in (symbols, word, slot, rank, each))
                if not len(symbols):
                    break
            hit = rank == each
            # In a run of one symbol the hits overlap: every second one merges.
            place = np.arange(len(hit))
            begins = hit & ~np.concatenate([[False], hit[:-1]])
            run = np.maximum.accumulate(np.where(begins, place, 0))
            hit &= (place - run) % 2 == 0
            symbols = np.where(hit, self.made[slot], symbols)
            keep = ~np.concatenate([[False], hit[:-1]])
            symbols, word = symbols[keep], word[keep]
        symbols, word = np.concatenate(done_symbols or [symbols]), np.concatenate(done_words or [word])
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(lengths))

    def merge_long(self, symbols: list[int]) -> list[int]:
        """One long word, pair by pair with a heap: a round per merge over all
        its symbols would cost their square."""
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j < n:
                key = symbols[i] * self.size + symbols[j]
                at = int(np.searchsorted(self.keys, key))
                if at < len(self.keys) and self.keys[at] == key:
                    heapq.heappush(heap, (int(self.rank[at]), i, symbols[i], symbols[j], int(self.made[at])))

        for i in range(n):
            push(i)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], alive[j], after[i] = made, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [s for s, a in zip(symbols, alive) if a]


class MergeEncoder(ChunkStore):
    """Chunks encoded by numpy merge rounds."""

    def __init__(self, path: str, limit: int = 300_000):
        self.vocabulary = Vocabulary(path)
        super().__init__(True, limit)

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        v = self.vocabulary
        words: list[bytes] = []
        owner: list[int] = []
        fixed: dict[int, int] = {}  # place among the words -> special id
        for i, chunk in enumerate(chunks):
            parts = v.special.split(chunk) if any(s in chunk for s in v.added) else [chunk]
            for part in parts:
                if part in v.added:
                    fixed[len(words)] = v.added[part]
                    words.append(b"\0")
                    owner.append(i)
                else:
                    found = v.words(part)
                    words += [w.encode() for w in found]
                    owner += [i] * len(found)
        if not words:
            return np.zeros(0, np.uint32), np.zeros(len(chunks), np.int64)
        size = np.array([len(w) for w in words], np.int64)
        long = np.flatnonzero(size > LONG_WORD)
        held = {int(i): v.merge_long(v.byte_id[np.frombuffer(words[i], np.uint8)].tolist()) for i in long}
        for i in held:
            words[i], size[i] = b"\0", 1
        ids, counts = v.merge_words(v.byte_id[np.frombuffer(b"".join(words), np.uint8)], size)
        held |= {i: [x] for i, x in fixed.items()}
        if held:
            start, last, parts = np.cumsum(counts) - counts, 0, []
            for i in sorted(held):
                parts += [ids[last: start[i]], np.array(held[i], np.int64)]
                last = start[i] + counts[i]
            ids = np.concatenate([*parts, ids[last:]])
            for i, x in held.items():
                counts[i] = len(x)
        return ids.astype(np.uint32), np.bincount(np.array(owner), counts, len(chunks)).astype(np.int64)


def _encoder(path: str) -> MergeEncoder:
    return cached(("merge", path), lambda: MergeEncoder(path))


def decode_flat(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bytes of id lists laid end to end, and n + 1 byte offsets."""
    ids = ids.astype(np.int64)
    length = np.where(ids < v.size, v.token_len[np.minimum(ids, v.size - 1)], 0)
    raw = v.token_bytes[ragged(v.token_start[np.minimum(ids, v.size - 1)], length)].tobytes()
    return raw, np.concatenate([[0], np.cumsum(length)])[offsets]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of every whole text (null: empty text, no ids)."""

    def run(batches):
        enc = _encoder(path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, off = enc.encode(texts_of(part, "text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(off.astype(np.int32), ids.view(np.int32))],
                    names=["doc_id", "ids"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, ids array<int>"))


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of every id list (null list or null ids: nothing)."""

    def run(batches):
        v = _encoder(path).vocabulary
        for batch in batches:
            lists = batch.column("ids")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat = pc.fill_null(lists.flatten(), v.size).to_numpy().astype(np.uint32)
            raw, off = decode_flat(v, flat, np.concatenate([[0], np.cumsum(sizes)]))
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return (rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
            .mapInArrow(run, "doc_id long, text string"))


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass over the texts; per document the number of
    ids, the sha256 of the decimal ids joined by commas and of the decoded text.
    The id lists need not travel through the JVM between the two steps."""

    def run(batches):
        enc = _encoder(path)
        v = enc.vocabulary
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                ids, off = enc.encode(texts_of(part, "text"))
                raw, cut = decode_flat(v, ids, off)
                at = ids.astype(np.int64)
                digits = v.digits[ragged(v.digit_start[at], v.digit_len[at])].tobytes()
                ends = np.concatenate([[0], np.cumsum(v.digit_len[at])])[off]
                said = [hashlib.sha256(digits[a: max(a, b - 1)]).hexdigest()
                        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                back = [hashlib.sha256(raw[a:b].decode("utf-8", "replace").encode()).hexdigest()
                        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(off)), pa.array(said), pa.array(back)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
