"""Token ids of whole texts through the ``tokenizers`` library.

Texts repeat words far more often than they invent them, so a text is cut at
spaces where the tokenizer's own split also cuts, every distinct chunk is
encoded once, and the ids of the texts are gathered from the chunks' ids with
numpy.  The ids are those of encoding the whole text.
"""

from __future__ import annotations

import os
import re
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tickloom.llm.common import ragged

# Unicode White_Space before a space: there a space does not start a new chunk.
_SPACE_AFTER_SPACE = (r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
                      r"\x{202f}\x{205f}\x{3000}] ")


#: Chunks a worker remembers, about 250 bytes each.
REMEMBERED = 200_000


class ChunkStore:
    """Ids of distinct chunks; subclasses say how missing chunks are encoded.

    ``keeps_spaces``: the tokenizer glues a space to the word behind it
    (byte-level BPE) instead of dropping white space.  Then a chunk is a space
    and what follows up to the next space, and a text with a space after other
    white space is one chunk as a whole.  When the store holds ``limit`` chunks
    it drops those met in one call only, so a worker's memory is bounded.
    """

    def __init__(self, keeps_spaces: bool, limit: int = REMEMBERED):
        self.keeps_spaces, self.limit = keeps_spaces, limit
        self._reset()

    def _reset(self):
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)  # met by a later call too

    def _forget(self):
        """Keep the chunks met again since they came or were last kept; none,
        if they fill half the store."""
        chunks = [c for c, i in self.index.items() if self.again[i]]
        at = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        length = self.length[at]
        if 2 * len(at) > self.limit or length.sum() > 8 * self.limit:
            self._reset()
            return
        self.ids = self.ids[ragged(self.start[at], length)]
        self.start, self.length = np.cumsum(length) - length, length
        self.index = dict(zip(chunks, range(len(chunks))))
        self.again = np.zeros(len(chunks), bool)

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the chunks and each chunk's number of ids."""
        raise NotImplementedError

    def apart(self, texts: pa.Array) -> pa.Array:
        """Texts with the same ids whose words repeat more often, where white
        space is dropped."""
        return texts

    def _add(self, chunks: list[str]) -> int:
        """Append chunks to the store; the index of the first."""
        first = len(self.start)
        flat, lengths = self.encode_chunks(chunks)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.ids = np.concatenate([self.ids, flat.astype(np.uint32)])
        self.again = np.concatenate([self.again, np.zeros(len(lengths), bool)])
        return first

    def _find(self, chunks: list[str]) -> np.ndarray:
        place = np.fromiter(map(self.index.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = place < 0
        self.again[place[~new]] = True
        missing = list(compress(chunks, new.tolist()))
        if missing:
            first = self._add(missing)
            place[new] = np.arange(first, first + len(missing))
            self.index.update(zip(missing, range(first, first + len(missing))))
        return place

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls), one after the other, and n + 1 offsets."""
        if len(self.start) > self.limit or len(self.ids) > 16 * self.limit:
            self._forget()
        n = len(texts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        odd = np.zeros(n, bool)
        whole: list[str] = []
        if self.keeps_spaces:
            found = pc.match_substring_regex(texts, _SPACE_AFTER_SPACE)
            odd = found.to_numpy(zero_copy_only=False)
            if odd.any():
                whole = texts.filter(found).to_pylist()
                texts = pc.if_else(found, "", texts)
        else:
            texts = self.apart(texts)
        pieces = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(pieces).to_numpy().astype(np.int64)
        first = np.cumsum(counts) - counts
        coded = pieces.flatten().dictionary_encode()
        key = coded.indices.to_numpy().astype(np.int64)
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.keeps_spaces:
            key = 2 * key + 1
            key[first] -= 1
            seen = np.zeros(2 * len(words), bool)
            seen[key] = True
            used = np.flatnonzero(seen)
            chunks = [" " + words[u >> 1] if u & 1 else words[u >> 1] for u in used.tolist()]
            place = np.zeros(len(seen), np.int64)
            place[used] = self._find(chunks)
        else:
            place = self._find(words)
        at = place[key]
        if whole:  # uncut texts are encoded as they are and not remembered
            at[first[odd]] = self._add(whole) + np.arange(len(whole))
        lengths = self.length[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[ragged(self.start[at], lengths)]
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]


# Words that lower-casing and normalisation leave as they are.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch
# A space and what follows, with no white space at the end: the split of a
# byte-level tokenizer cuts before the next chunk's space.
_LED = re.compile(r" [^ <]{0,998}[^\s<]").fullmatch


class LibraryEncoder(ChunkStore):
    """Chunks encoded by the ``tokenizers`` library, special strings in the
    text recognised as it does, its truncation and padding off.

    ``separator`` is a special token of the file: between chunks it keeps them
    apart, so that one call encodes hundreds.
    """

    GROUP = 200

    def __init__(self, path: str, separator: str, keeps_spaces: bool, limit: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.separator, self.separator_id = separator, self.tokenizer.token_to_id(separator)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        # A byte-level vocabulary writes the space byte as U+0120.
        self.starts_chunk = np.zeros(len(self.ends_word), bool)
        self.starts_chunk[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        super().__init__(keeps_spaces, limit)

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def apart(self, texts: pa.Array) -> pa.Array:
        # ASCII capitals, line ends and a mark behind a word make no difference to
        # a tokenizer that lower-cases, drops white space and splits words from marks.
        # Before a combining mark a capital does: it may compose with the small letter only.
        if pc.any(pc.match_substring_regex(texts, r"<\||[A-Z]\p{M}")).as_py():
            return texts
        texts = pc.ascii_lower(pc.replace_substring(texts, "\n", " "))
        return pc.replace_substring_regex(texts, r"([a-z])([.,]) ", r"\1 \2 ")

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Chunks that can stand next to each other and be told apart by their ids.
        fits = _LED if self.keeps_spaces else _PLAIN
        plain = np.array([fits(c) is not None for c in chunks], bool)
        if not plain.any():
            return self._encode_any(chunks)
        words = [c for c, p in zip(chunks, plain) if p]
        between = "" if self.keeps_spaces else " "
        out = self._batch([between.join(words[a: a + self.GROUP]) for a in range(0, len(words), self.GROUP)])
        flat = np.fromiter(chain.from_iterable(out), np.uint32)
        if self.keeps_spaces:
            first = np.flatnonzero(self.starts_chunk[flat])
            told = len(first) == len(words) and first[0] == 0
            sizes = np.diff(first, append=len(flat))
        else:
            stop = np.flatnonzero(self.ends_word[flat])
            told = len(stop) == len(words) and stop[-1] == len(flat) - 1
            sizes = np.diff(stop, prepend=-1)
        if not told:
            return self._encode_any(chunks)  # not a vocabulary that marks word limits
        lengths = np.zeros(len(chunks), np.int64)
        lengths[plain] = sizes
        others, other_lengths = self._encode_any([c for c, p in zip(chunks, plain) if not p])
        lengths[~plain] = other_lengths
        start = np.cumsum(lengths) - lengths
        merged = np.zeros(int(lengths.sum()), np.uint32)
        merged[ragged(start[plain], lengths[plain])] = flat
        merged[ragged(start[~plain], other_lengths)] = others
        return merged, lengths

    def _encode_any(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lengths = np.zeros(len(chunks), np.int64)
        # A chunk that may hold a special string, or is long, goes alone.
        alone = [i for i, c in enumerate(chunks) if "<|" in c or len(c) > 1000]
        apart = set(alone)
        joint = [i for i in range(len(chunks)) if i not in apart] if alone else range(len(chunks))
        groups = [[chunks[i] for i in joint[a: a + self.GROUP]] for a in range(0, len(joint), self.GROUP)]
        out = self._batch([self.separator.join(g) + self.separator for g in groups])
        flat = np.fromiter(chain.from_iterable(out), np.uint32)
        mark = flat == self.separator_id
        cut = np.flatnonzero(mark)
        lengths[np.asarray(joint, np.int64)] = np.diff(cut, prepend=-1) - 1
        flat = flat[~mark]
        if alone:
            singles = self._batch([chunks[i] for i in alone])
            lengths[np.asarray(alone)] = [len(s) for s in singles]
            merged = np.zeros(int(lengths.sum()), np.uint32)
            start = np.cumsum(lengths) - lengths
            j = np.asarray(joint, np.int64)
            merged[ragged(start[j], lengths[j])] = flat
            a = np.asarray(alone)
            merged[ragged(start[a], lengths[a])] = np.fromiter((x for s in singles for x in s), np.uint32)
            flat = merged
        return flat, lengths


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every text's ids."""
    n = len(offsets) - 1
    moved = offsets + np.arange(n + 1)
    out = np.empty(len(ids) + n, np.uint32)
    ends = moved[1:] - 1
    body = np.ones(len(out), bool)
    body[ends] = False
    out[ends] = end_id
    out[body] = ids
    return out, moved
