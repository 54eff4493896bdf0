"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are distinct texts: labelled documents with one word sequence count once,
with the label of most of them.  Every lower-case alphanumeric word of the
examples is a dimension.  A term weighs (1 + ln tf) * idf * rf: the inverse document
frequency is counted over all documents, and rf = log2(2 + a / max(1, c)) is the
relevance frequency of supervised term weighting (a toxic and c clean examples
hold the word).  Without it neighbours share topics, not tone; with it no word
is dropped.

Entries stand in blocks of an inverted index that keeps frequent terms' largest
weight in every block.  A query's bound for a block is what its best entry has of
the rare terms plus the frequent terms' maxima; blocks are scored exactly in
bound order until the k-th best similarity exceeds every bound left, so the
neighbours are exact.  The raw score is
the toxic share of the k nearest examples, weighted by squared similarity and drawn
to the overall rate where neighbours are few or far.  It is calibrated on the
examples themselves, each judged by the others: the cut with the best F1 becomes
one half, linear below and above it.  The neighbours are returned as evidence.

Examples: at most ``max_examples`` distinct labelled texts (a documented parameter),
chosen by their hash, which bounds the index.  Document frequencies cover all
documents, a group of copies counting about once (a table of 2^18 cells of text
hashes, 1 MB whatever the input, and one sum per word of the examples), and every
document is scored whole, in one pass without a shuffle.  What is sent to workers are plain
arrays, so they need no copy of this package.

Defined cases: a null text is empty; a text without known terms (an empty one
too) gets the rate of examples without any word, calibrated alike, and no evidence;
without usable labels every score is 0.0; repeated rows are scored alike; other
columns pass through, and clashing output names need another ``score_col`` or
``evidence_col`` (an error says so).
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import (append_columns, bytes_of, ceil_div, labelled, materialize, ragged, spare, text_slices,
                                 texts_of)
from tickloom.llm.weighted_minhash import DF_PARTS, copy_hashes
from tickloom.llm.wordhash import U64, not_alphanumeric, span_hashes, word_spans

MAX_EXAMPLES = 4096
NEIGHBOURS = 15
BLOCK = 8
COPY_BITS = 18
FREQUENT = 32        # terms at most whose lists are matrix columns
PRIOR_WEIGHT = 0.25
REMEMBERED = 20_000  # texts whose judgement a task keeps, for copies

EVIDENCE = "array<struct<doc_id: bigint, similarity: double, toxic_share: double>>"


def word_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word hash, occurrences) of all texts, sorted by text and hash."""
    raw, off = bytes_of(pc.utf8_lower(texts))
    starts, ends, first = word_spans(raw, off, not_alphanumeric())
    h = span_hashes(raw, starts, ends)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])]) if len(h) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    return text[head], h[head], np.diff(head, append=len(h))


def term_weights(n_docs: float, df: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """idf * rf of every term from its document frequency over all documents and
    the toxic and clean examples that hold it."""
    return (np.log((1 + n_docs) / (1 + df)) + 1e-3) * np.log2(2 + toxic / np.maximum(1, clean))


class Index:
    """The block-max inverted index; every argument is a plain array.

    ``hashes`` (sorted) and ``weights`` name the terms; entry i holds the terms
    ``entry_term[indptr[i]: indptr[i + 1]]`` with unit-length weights.  Lists of
    frequent terms, which hold most entries, are stored as columns of one matrix
    with a maximum per block; all other lists as postings."""

    def __init__(self, hashes, weights, indptr, entry_term, entry_weight):
        self.hashes, self.weights = hashes, weights
        n = len(indptr) - 1
        self.n_entries, self.n_blocks = n, -(-n // BLOCK)
        entry = np.repeat(np.arange(n), np.diff(indptr))
        df = np.bincount(entry_term, minlength=len(hashes))
        frequent = np.argsort(-df, kind="stable")[:FREQUENT]
        frequent = frequent[df[frequent] > max(BLOCK, n // 32)]
        self.column = np.full(len(hashes), -1, np.int64)
        self.column[frequent] = np.arange(len(frequent))
        wide = self.column[entry_term] >= 0
        self.dense = np.zeros((self.n_blocks * BLOCK, len(frequent)))
        self.dense[entry[wide], self.column[entry_term[wide]]] = entry_weight[wide]
        self.dense = self.dense.reshape(self.n_blocks, BLOCK, len(frequent))
        self.most = np.ascontiguousarray(self.dense.max(1).T)  # one row a term: its maximum in every block
        order = np.flatnonzero(~wide)[np.argsort(entry_term[~wide], kind="stable")]
        self.post_entry, self.post_weight = entry[order], entry_weight[order]
        self.lists = np.searchsorted(entry_term[order], np.arange(len(hashes) + 1))

    def terms(self, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Known terms among word hashes, and their unit-length weights."""
        at = np.minimum(np.searchsorted(self.hashes, h), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
        w = (1 + np.log(n[known])) * self.weights[at[known]]
        return at[known], w / max(np.sqrt((w * w).sum()), 1e-300)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, without: int = -1):
        """Exact k nearest entries other than ``without``: (entries, similarities),
        nearest first, ties to the smaller entry.  Postings give every entry's
        share of the rare terms; with the frequent terms' block maxima that bounds
        each block, and blocks are completed in bound order until no bound left
        reaches the k-th similarity."""
        size = self.lists[term + 1] - self.lists[term]
        rows = ragged(self.lists[term], size)
        rare = np.bincount(self.post_entry[rows], np.repeat(weight, size) * self.post_weight[rows], self.n_blocks * BLOCK)
        rare = rare.reshape(self.n_blocks, BLOCK)
        column = self.column[term]
        wide = column >= 0
        query = np.zeros(self.dense.shape[2])
        query[column[wide]] = weight[wide]
        bound = rare.max(1, initial=0.0) + weight[wide] @ self.most[column[wide]]
        todo = np.argsort(-bound, kind="stable")
        todo = todo[bound[todo] > 0]
        found_e, found_s = np.zeros(0, np.int64), np.zeros(0)
        at, width = 0, 2 + 2 * k // BLOCK
        while at < len(todo):
            if len(found_s) >= k:  # only blocks that can still hold a neighbour
                todo = todo[: at + np.searchsorted(-bound[todo[at:]], -(found_s[k - 1] - 1e-12), side="right")]
                if at >= len(todo):
                    break
            blocks = todo[at: at + width]
            s = (rare[blocks] + self.dense[blocks] @ query).ravel()
            e = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            at, width = at + width, 2 * width
            use = (s > 0) & (e != without)
            if len(found_s) >= k:
                use &= s >= found_s[k - 1]
            found_e, found_s = np.concatenate([found_e, e[use]]), np.concatenate([found_s, s[use]])
            best = np.lexsort((found_e, -found_s))[:k]
            found_e, found_s = found_e[best], found_s[best]
        return found_e, found_s


def vote(similarity: np.ndarray, label: np.ndarray, prior: float) -> float:
    """Toxic share of the neighbours, weighted by squared similarity and drawn to
    the examples' toxic rate by a small weight."""
    near = similarity * similarity
    return float(((near * label).sum() + PRIOR_WEIGHT * near.mean() * prior) / (near.sum() + PRIOR_WEIGHT * near.mean()))


def best_cut(raw: np.ndarray, label: np.ndarray) -> float:
    """The raw score from which on calling texts toxic has the best F1, halfway to
    the next lower score."""
    order = np.argsort(-raw, kind="stable")
    raw, label = raw[order], label[order]
    f1 = 2 * np.cumsum(label) / (np.arange(1, len(raw) + 1) + max(label.sum(), 1))
    last = np.append(raw[1:] < raw[:-1], True)  # equal scores go together
    at = int(np.argmax(np.where(last, f1, -1)))
    below = raw[at + 1] if at + 1 < len(raw) else 0.0
    return float(np.clip((raw[at] + below) / 2, 1e-6, 1 - 1e-6))


def calibrated(raw: float, cut: float) -> float:
    return 0.5 * raw / cut if raw < cut else 0.5 + 0.5 * (raw - cut) / (1 - cut)


def keys(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the 128-bit hash of every text's word sequence."""
    return append_columns(rows, "text", "key_a long, key_b long", lambda: copy_hashes, keep)


def copy_weights(keyed: DataFrame) -> np.ndarray:
    """1 / number of documents whose word sequence falls into each of 2^18 cells:
    what a document counts for, so that a group of copies counts about once
    however large it is.  Texts that share a cell by chance count for less, all
    alike, which leaves shares of documents as they are."""
    cell = F.shiftrightunsigned("key_a", 64 - COPY_BITS).alias("cell")
    rows = keyed.groupBy(cell).agg(F.count("*").alias("n")).toArrow()  # 2^18 rows at most
    out = np.ones(1 << COPY_BITS, np.float32)
    out[rows.column("cell").to_numpy()] = 1 / rows.column("n").to_numpy()
    return out


def word_frequencies(named: DataFrame, weights: np.ndarray, hashes: np.ndarray) -> tuple[float, np.ndarray]:
    """Weight of all documents, and of those with each of the words ``hashes``
    (sorted), over all documents; each task sends its sums in compressed parts."""
    size = ceil_div(len(hashes), DF_PARTS)
    shipped = named.sparkSession.sparkContext.broadcast((weights, hashes))  # the examples bound its size

    def count(batches):
        weights, hashes = shipped.value
        n, df = 0.0, np.zeros(size * DF_PARTS)
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = texts_of(part, "text")
                own = weights[(copy_hashes(texts)[0].to_numpy().view(U64) >> U64(64 - COPY_BITS)).astype(np.int64)]
                row, h, _ = word_counts(texts)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                    known = hashes[at] == h
                    df += np.bincount(at[known], own[row[known]], len(df))
                n += float(own.sum())
        if n:
            rows = [pa.compress(x.astype("<f8").tobytes(), "zstd", asbytes=True) for x in df.reshape(DF_PARTS, -1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, DF_PARTS)), pa.array([n] + [0.0] * DF_PARTS), pa.array([b"", *rows], pa.binary())],
                names=["part", "n", "sums"])
        spare()

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for x in table.column("sums"):
            if len(x.as_buffer()):
                total += np.frombuffer(pa.decompress(x.as_buffer(), 8 * size, "zstd", asbytes=True), "<f8")
        return pa.table({"part": table.column("part")[:1], "n": pa.array([pc.sum(table.column("n")).as_py()]),
                         "sums": pa.array([total.tobytes()], pa.binary())})

    kind = "part long, n double, sums binary"
    rows = named.select("text").mapInArrow(count, kind).groupBy("part").applyInArrow(add, kind).collect()
    df, n = np.zeros(size * DF_PARTS), 0.0
    for r in rows:
        if r.part < 0:
            n = r.n
        else:
            df[r.part * size: (r.part + 1) * size] = np.frombuffer(r.sums, "<f8")
    shipped.destroy()
    return n, df[:len(hashes)]


def distinct_examples(named: DataFrame, all_keys: DataFrame, labels: DataFrame, wanted: Column,
                      max_examples: int) -> DataFrame:
    """doc_id, text and label of distinct labelled texts: the smallest document of
    each word sequence, the label of most of its documents."""
    known = labelled(labels, "toxic", wanted)
    keyed = all_keys.join(known, "doc_id")  # ids and hashes only
    chosen = keyed.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("doc_id"),
                                                 (F.avg("label") >= 0.5).cast("int").alias("label"))
    chosen = materialize(chosen.orderBy("key_a", "key_b").limit(max_examples), "toxic_chosen")
    picked = chosen.select("doc_id", "label", F.col("key_a").alias("a"), F.col("key_b").alias("b"))
    again = named.join(F.broadcast(picked), "doc_id")  # max_examples rows of 28 bytes
    same = keys(again, again.columns).filter((F.col("key_a") == F.col("a")) & (F.col("key_b") == F.col("b")))
    return same.groupBy("a", "b").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"),
                                      F.min("label").alias("label")).select("doc_id", "text", "label")


def learn(docs: DataFrame, labels: DataFrame, wanted: Column, max_examples: int = MAX_EXAMPLES,
          id_col: str = "doc_id", text_col: str = "text", k: int = NEIGHBOURS) -> dict:
    """The neighbourhood of the labelled documents for which ``wanted`` (over
    doc_id) holds: plain arrays, bounded by ``max_examples``."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    all_keys = materialize(keys(named, ["doc_id"]), "toxic_keys")
    sample = materialize(distinct_examples(named, all_keys, labels, wanted, max_examples), "toxic_examples")

    def vectors():
        def compute(texts):
            row, h, n = word_counts(texts)
            off = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
            return [pa.ListArray.from_arrays(off, pa.array(v)) for v in (h.view(np.int64), n.astype(np.int32))]
        return compute

    got = append_columns(sample, "text", "hashes array<long>, counts array<int>", vectors, ["doc_id", "label"]).toArrow()
    ids = got.column("doc_id").to_numpy().astype(np.int64)
    label = got.column("label").to_numpy().astype(np.float64)
    if not len(ids):
        return {"empty": True}
    lists = [got.column(c).combine_chunks() for c in ("hashes", "counts")]
    size = pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = [x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists]
    hashes, term = np.unique(flat[0].view(U64), return_inverse=True)
    n_docs, df = word_frequencies(named, copy_weights(all_keys), hashes)
    owner = np.repeat(np.arange(len(ids)), size)
    toxic = np.bincount(term, label[owner], len(hashes))
    clean = np.bincount(term, minlength=len(hashes)) - toxic
    weights = term_weights(n_docs, df, toxic, clean)
    w = (1 + np.log(flat[1])) * weights[term]
    length = np.sqrt(np.bincount(owner, w * w, len(ids)))
    # Entries with the same strongest word share blocks, which keeps bounds tight.
    strongest = np.full(len(ids), -1, np.int64)
    order = np.lexsort((w, owner))
    last = np.flatnonzero(np.diff(owner[order], append=-1))
    strongest[owner[order[last]]] = term[order[last]]
    entries = np.lexsort((ids, strongest, label))
    entries = entries[size[entries] > 0]
    begin = np.cumsum(size) - size
    rows = ragged(begin[entries], size[entries])
    indptr = np.concatenate([[0], np.cumsum(size[entries])])
    prior = float(label.mean())
    empty = size == 0
    model = {"hashes": hashes, "weights": weights, "indptr": indptr, "entry_term": term[rows],
             "entry_weight": w[rows] / length[owner[rows]], "label": label[entries], "ids": ids[entries], "prior": prior,
             "none": float((label[empty].sum() + prior) / (empty.sum() + 1)), "cut": 0.5, "empty": False}
    index = index_of(model)
    raw = np.full(len(entries), model["none"])
    for i in range(len(entries)):  # every example judged by the others
        part = slice(indptr[i], indptr[i + 1])
        near, sim = index.nearest(model["entry_term"][part], model["entry_weight"][part], k, i)
        if len(near):
            raw[i] = vote(sim, model["label"][near], prior)
    if len(entries):
        model["cut"] = best_cut(raw, model["label"])
    return model


def index_of(model: dict) -> Index:
    return Index(*(model[c] for c in ("hashes", "weights", "indptr", "entry_term", "entry_weight")))


def with_toxicity(docs: DataFrame, model: dict, text_col: str = "text", score_col: str = "score",
                  evidence_col: str = "evidence", k: int = NEIGHBOURS, shown: int = 3, keep=None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with a score from 0 to 1 and the nearest
    labelled examples."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # the examples bound its size

    def start():
        model = shipped.value
        index, known = None if model["empty"] else index_of(model), {}
        base = 0.0 if model["empty"] else calibrated(model["none"], model["cut"])

        def judge(h, n):
            key = blake2b(h.tobytes() + n.tobytes(), digest_size=16).digest()
            if key in known:
                return known[key]
            near, sim = index.nearest(*index.terms(h, n), k)
            told = [{"doc_id": int(model["ids"][e]), "similarity": float(s), "toxic_share": float(model["label"][e])}
                    for e, s in zip(near[:shown], sim[:shown])]
            out = (calibrated(vote(sim, model["label"][near], model["prior"]), model["cut"]) if len(near) else base, told)
            if len(known) >= REMEMBERED:
                known.clear()
            known[key] = out
            return out

        def compute(texts):
            score, told = np.full(len(texts), base), [[] for _ in range(len(texts))]
            if index is not None:
                row, h, n = word_counts(texts)
                cut = np.flatnonzero(np.diff(row, prepend=-1))
                for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(row)]):
                    score[row[a]], told[row[a]] = judge(h[a:b], n[a:b])
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()),
                                       ("toxic_share", pa.float64())]))
            return [pa.array(score), pa.array(told, kind)]

        return compute

    return append_columns(docs, text_col, f"`{score_col}` double, `{evidence_col}` {EVIDENCE}", start, keep)
