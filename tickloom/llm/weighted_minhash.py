"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF
shingles, banded, verified by weighted Jaccard similarity.

Words are lower-case alphanumeric runs, shingles five words.  A shingle weighs
tf * ln(1 + N / df).  Its document frequency is estimated from those of its words,
counted over all documents, as if words were independent (at least one):
N * prod(df_w / N).  Counted shingle frequencies would fail here: in a group of
thousands of copies the shared shingles would weigh a third of the edited ones,
and copies with few edits would fall below the threshold.  Word frequencies are
counted in a table of 2^20 hash cells, a fixed 4 MB that is broadcast.

Signatures: for every hash k a shingle of weight w draws r, c ~ Gamma(2, 1) and
beta ~ U(0, 1) from its hash, t = floor(ln w / r + beta), ln a = ln c - r (t - beta + 1);
the shingle of least a with its t is the sample.  Two documents agree on a
sample with probability equal to their weighted Jaccard similarity.  Samples are
banded; at the threshold 0.8, 16 bands of 4 miss one pair in 5000.

Documents with one word sequence (128-bit hash) are copies and share all
decisions; only their smallest document goes on.  Documents that share a band
form a bucket; of buckets with the same members one is kept.  All texts of a
bucket are compared, in pairs of tiles of bounded size, by adding up the weights
of shared shingles; a tile pair returns links that join its components, never
all its pairs.  Where members have hundreds of bucket-mates on average, each is
first compared with its bucket's smallest, and only buckets that are not one
component then are compared in full.  No bucket is capped and no link between
components is left out.

Defined cases: null texts and texts without words are each a class of their
own; texts shorter than a shingle count as one shingle; every row is a document
of its own, also where it repeats a doc_id or has none, so unlike texts under one id
are never merged; a group whose rows all lack an id has a null class; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import bytes_of, cached, free_name, materialize, spare, text_slices, texts_of
from tickloom.llm.components import connected_components
from tickloom.llm.wordhash import U64, mix, not_alphanumeric, run_hashes, span_hashes, word_spans

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
DF_BITS = 20
DF_PARTS = 64
FEW = 8              # groups up to this size are compared together
TILE = 256           # texts of a bucket's tile
TILE_WEIGHT = 4e6    # and their total weight, about 300,000 shingles
TILE_BYTES = 2 << 20
PARTNERS = 512       # mean bucket-mates of a member above which pivots go first

SIGNATURES = "doc_id long, text_key long, copy_a long, copy_b long, weight double, bands array<long>"


NAMES = ["doc_id", "text_key", "copy_a", "copy_b", "weight", "bands"]


class Words:
    """Hashes of the words of many texts."""

    def __init__(self, texts: pa.Array):
        raw, off = bytes_of(pc.utf8_lower(texts))
        starts, ends, self.first = word_spans(raw, off, not_alphanumeric())
        self.hash = span_hashes(raw, starts, ends)
        self.count = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(texts)), self.count)

    def cell(self) -> np.ndarray:
        return (self.hash >> U64(64 - DF_BITS)).astype(np.int64)


def copy_hashes(texts: pa.Array) -> list[pa.Array]:
    """128-bit hash of every text's word sequence, as two columns."""
    w = Words(texts)
    return [pa.array(c.view(np.int64)) for c in sequence_hashes(w)]


def sequence_hashes(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every text's words in order; zero for texts without words."""
    place = (np.arange(len(w.hash)) - w.first[w.owner]).astype(U64)
    some = np.flatnonzero(w.count)
    out = []
    for odd, odd2 in ((3, 0x9E3779B97F4A7C15), (5, 0xD1342543DE82EF95)):
        h = np.zeros(len(w.count), U64)
        if len(some):
            h[some] = np.add.reduceat(mix(mix(w.hash * U64(odd)) + mix(place * U64(odd2))), w.first[some])
        out.append(h)
    return out[0], out[1]


def word_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with a word of each hash cell, over all
    documents; each task sends its counts in compressed parts."""
    size = (1 << DF_BITS) // DF_PARTS

    def count(batches):
        n, df = 0, np.zeros(1 << DF_BITS, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                w = Words(texts_of(part, "text"))
                key = np.sort((w.owner << DF_BITS) | w.cell())
                key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
                df += np.bincount(key & ((1 << DF_BITS) - 1), minlength=len(df))
                n += part.num_rows
        if n:
            rows = [pa.compress(x.astype("<i8").tobytes(), "zstd", asbytes=True) for x in df.reshape(DF_PARTS, -1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, DF_PARTS)), pa.array([n] + [0] * DF_PARTS, pa.int64()),
                 pa.array([b"", *rows], pa.binary())], names=["part", "n", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(size, np.int64)
        for x in table.column("counts"):
            if len(x.as_buffer()):
                total += np.frombuffer(pa.decompress(x.as_buffer(), 8 * size, "zstd", asbytes=True), "<i8")
        return pa.table({"part": table.column("part")[:1], "n": pa.array([pc.sum(table.column("n")).as_py()], pa.int64()),
                         "counts": pa.array([total.tobytes()], pa.binary())})

    kind = "part long, n long, counts binary"
    rows = docs.select("text").mapInArrow(count, kind).groupBy("part").applyInArrow(add, kind).collect()
    df, n = np.zeros(1 << DF_BITS, np.int64), 0
    for r in rows:
        if r.part < 0:
            n = r.n
        else:
            df[r.part * size: (r.part + 1) * size] = np.frombuffer(r.counts, "<i8")
    return n, df


def word_surprise(n_docs: int, df: np.ndarray) -> np.ndarray:
    """-ln of each cell's share of documents."""
    return np.log((n_docs + 1) / (df + 1)).astype(np.float32)


def shingles(w: Words, surprise: np.ndarray, n_docs: int, size: int):
    """Distinct shingles of every text, ordered by text and hash: (text, hash,
    weight)."""
    h = run_hashes(w.hash, size)
    rare = surprise[w.cell()].astype(np.float64)
    total = np.concatenate([[0.0], np.cumsum(rare)])
    at = np.arange(len(h))
    at = at[w.owner[at] == w.owner[at + size - 1]] if len(at) else at
    text, key, score = w.owner[at], h[at], total[at + size] - total[at]
    short = np.flatnonzero((w.count > 0) & (w.count < size))
    if len(short):  # one shingle of all words
        key_s = np.array([mix(run_hashes(w.hash[w.first[i]: w.first[i + 1]], int(w.count[i])))[0] for i in short], U64)
        text = np.concatenate([text, short])
        key = np.concatenate([key, key_s])
        score = np.concatenate([score, total[w.first[short + 1]] - total[w.first[short]]])
    order = np.argsort((text.astype(U64) << U64(44)) | (key >> U64(20)), kind="stable")
    text, key, score = text[order], key[order], score[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])]) if len(key) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    tf = np.diff(head, append=len(key))
    idf = np.log1p(np.exp(np.minimum(score[head], np.log(max(n_docs, 1)))))
    return text[head], key[head], tf * idf


def gamma_table() -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of 2^16 equal shares."""
    share = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros(1 << 16), np.full(1 << 16, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < share
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return ((low + high) / 2).astype(np.float32)


def samples(key: np.ndarray, weight: np.ndarray, starts: np.ndarray, n_hashes: int) -> np.ndarray:
    """Consistent weighted samples of groups of shingles (each from its start to
    the next), one 32-bit value per group and hash."""
    gamma = cached("gamma", gamma_table)
    log_gamma = cached("log_gamma", lambda: np.log(gamma) + np.float32(64))  # keeps ln a positive
    log_w = np.log(weight).astype(np.float32)
    out = np.empty((len(starts), n_hashes), np.uint32)
    low = U64(0xFFFF)
    for k in range(n_hashes):
        z = mix(key + U64((k * 0x9E3779B97F4A7C15 + 0x1234567) & (2 ** 64 - 1)))
        r = gamma[(z >> U64(48)).astype(np.uint16)]
        log_c = log_gamma[((z >> U64(32)) & low).astype(np.uint16)]
        beta = ((z >> U64(16)) & low).astype(np.float32) * np.float32(2.0 ** -16)
        t = np.floor(log_w / r + beta)
        log_a = log_c - r * (t - beta + np.float32(1))
        name = (z.astype(np.uint32) + t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1)).astype(U64)
        both = (log_a.view(np.uint32).astype(U64) << U64(32)) | name
        out[:, k] = np.minimum.reduceat(both, starts).astype(np.uint32)
    return out


def signatures(docs: DataFrame, model, bands: int, rows: int, size: int) -> DataFrame:
    """Band keys, copy hash and total weight of every row; null for rows without
    words."""

    def run(batches):
        n_docs, surprise = model.value
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                w = Words(texts_of(part, "text"))
                text, key, weight = shingles(w, surprise, n_docs, size)
                some, bare = np.flatnonzero(w.count), np.flatnonzero(w.count == 0)
                if len(bare):
                    at = pa.array(bare)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(at), part.column("text_key").take(at),
                         *(pa.nulls(len(bare), t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64())))],
                        names=NAMES)
                if not len(some):
                    continue
                starts = np.searchsorted(text, some)
                drawn = samples(key, weight, starts, bands * rows).astype(U64)
                band_keys = np.empty((len(some), bands), U64)
                for b in range(bands):
                    band = np.full(len(some), U64(b + 1))
                    for k in range(b * rows, (b + 1) * rows):
                        band = mix(band * U64(0x9E3779B97F4A7C15) + drawn[:, k])
                    band_keys[:, b] = band
                copies = [c[some] for c in sequence_hashes(w)]
                flat = pa.array(band_keys.view(np.int64).ravel())
                cut = pa.array(np.arange(len(some) + 1) * bands, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(some)), part.column("text_key").take(pa.array(some)),
                     *(pa.array(c.view(np.int64)) for c in copies),
                     pa.array(np.add.reduceat(weight, starts)), pa.ListArray.from_arrays(cut, flat)], names=NAMES)
            spare()

    return docs.mapInArrow(run, SIGNATURES)


def similar_pairs(group: np.ndarray, texts: pa.Array, surprise: np.ndarray, n_docs: int, size: int,
                  threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links (text, text) that join all texts of one group whose weighted
    Jaccard similarity reaches the threshold, groups being numbered from 0 in
    ascending order.  Similarities come from one pass over the shared shingles, so a
    pair costs an addition per shared shingle."""
    row, key, weight = shingles(Words(texts), surprise, n_docs, size)
    total = np.bincount(row, weight, len(group))
    order = np.lexsort((row, key, group[row]))
    row, key, weight = row[order], key[order], weight[order]
    home = group[row]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (home[1:] != home[:-1])]) if len(key) else np.zeros(0, bool)
    run = np.cumsum(new) - 1
    members = np.bincount(group)
    first = np.cumsum(members) - members
    few = members[home] <= FEW
    links = []
    r, w, k = row[few], weight[few], run[few]
    codes, shares = [], []
    for lag in range(1, FEW):
        hit = np.flatnonzero(k[lag:] == k[:-lag]) if len(k) > lag else np.zeros(0, np.int64)
        codes.append(r[hit] * len(group) + r[hit + lag])
        shares.append(np.minimum(w[hit], w[hit + lag]))
    code, at = np.unique(np.concatenate(codes), return_inverse=True)
    common = np.bincount(at, np.concatenate(shares), len(code))
    a, b = code // len(group), code % len(group)
    good = common >= (threshold - 1e-12) * (total[a] + total[b] - common)
    links.append((a[good], b[good]))
    for g in np.flatnonzero(members > FEW):
        n, base = int(members[g]), int(first[g])
        lo, hi = np.searchsorted(home, [g, g + 1])
        shared = np.zeros((n, n))
        cuts = np.flatnonzero(np.diff(run[lo:hi], prepend=-1))
        for x, y in zip((lo + cuts).tolist(), [*(lo + cuts[1:]).tolist(), int(hi)]):
            if y - x > 1:
                own = row[x:y] - base
                shared[own[:, None], own] += np.minimum.outer(weight[x:y], weight[x:y])
        both = total[base: base + n]
        near = shared >= (threshold - 1e-12) * (both[:, None] + both - shared)
        label = np.arange(n)
        while True:  # one link per text is enough: to its component's first
            least = np.minimum(label, np.where(near, label, n).min(1, initial=n))
            if (least == label).all():
                break
            label = least
        other = np.flatnonzero(label != np.arange(n))
        links.append((base + label[other], base + other))
    return links


def tile_links(rows: DataFrame, model, threshold: float, size: int) -> DataFrame:
    """Links (a, b) of rows (grp, rep, text): all texts of a group compared.
    Rows of a group come together and in order; a task holds a few groups."""

    def run(batches):
        n_docs, surprise = model.value

        def compare(table):
            grp = table.column("grp").to_numpy()
            group = np.cumsum(np.concatenate([[0], grp[1:] != grp[:-1]]))
            reps = table.column("rep").to_numpy()
            text = texts_of(table.select(["text"]).combine_chunks().to_batches()[0], "text")
            a, b = (np.concatenate(x) for x in zip(*similar_pairs(group, text, surprise, n_docs, size, threshold)))
            return pa.RecordBatch.from_arrays([pa.array(reps[a]), pa.array(reps[b])], names=["a", "b"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            grp = held.column("grp").to_numpy()
            edges = np.flatnonzero(grp[1:] != grp[:-1]) + 1  # the last group may go on
            length = np.cumsum(pc.binary_length(held.column("text")).to_numpy())
            at = 0
            while at < (edges[-1] if len(edges) else 0):
                base = length[at - 1] if at else 0
                fits = edges[(edges > at) & (length[edges - 1] <= base + TILE_BYTES)]
                stop = int(fits[-1]) if len(fits) else int(edges[edges > at][0])
                yield compare(held.slice(at, stop - at))
                at = stop
            held = held.slice(at)
        if held is not None and held.num_rows:
            yield compare(held)

    return rows.mapInArrow(run, "a long, b long")


def tiled(members: DataFrame, buckets: DataFrame, tile: int, tile_weight: float) -> DataFrame:
    """Members (grp, rep) of every pair of tiles of their bucket; buckets hold
    bucket, n and total weight."""
    tiles = F.ceil(F.greatest(F.col("n") / tile, F.col("total") / tile_weight)).cast("int")
    spread = members.join(buckets.select("bucket", tiles.alias("tiles")), "bucket").withColumn(
        "mine", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    spread = spread.withColumn("with", F.explode(F.expr("sequence(0, tiles - 1)")))
    # A tile meets itself only where it is the bucket's only one: pairs of two
    # tiles compare everything in them.
    spread = spread.filter((F.col("mine") != F.col("with")) | (F.col("tiles") == 1))
    return spread.select(F.xxhash64("bucket", F.least("mine", "with"), F.greatest("mine", "with")).alias("grp"), "rep")


def _classes(docs: DataFrame, threshold: float, bands: int, rows: int, size: int, id_col: str, text_col: str,
             tile: int, partners: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, copies, classes): every row with doc_id, text_key and the hash of
    its words (null without words); every distinct word sequence with its
    smallest document and its class; every class with its smallest document."""
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(text_col).alias("text_key"))
    n_docs, df = word_frequencies(named)
    model = spark.sparkContext.broadcast((n_docs, word_surprise(n_docs, df)))  # 4 MB whatever the input
    signed = materialize(signatures(named, model, bands, rows, size), "near_signatures")
    # A word sequence gets a number of its own, so neither missing nor repeated
    # ids confuse rows; the table is written, so the numbers stay.
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    reps = signed.filter(F.col("copy_a").isNotNull()).groupBy("copy_a", "copy_b").agg(
        F.min(first).alias("f"), F.min_by(F.struct("weight", "bands"), first).alias("r")).select(
            "copy_a", "copy_b", "f.unnamed", "f.doc_id", "f.text_key", "r.weight", "r.bands",
            F.monotonically_increasing_id().alias("rep"))
    reps = materialize(reps, "near_reps")
    placed = reps.select("rep", "weight", F.explode("bands").alias("bucket"))
    # Buckets of one member link nothing; of buckets with the same members one is enough.
    shared = (placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("low"), F.max("rep").alias("high"),
                                           F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("set"),
                                           F.sum("weight").alias("total"))
              .filter("n > 1").groupBy("n", "low", "high", "set")
              .agg(F.min("bucket").alias("bucket"), F.max("total").alias("total")))
    buckets = materialize(shared.select("bucket", "n", "low", "total"), "near_buckets")
    members = materialize(placed.join(buckets.select("bucket", "low"), "bucket").select("bucket", "rep", "low"),
                          "near_members")
    # A representative's text is the row with its id and text hash.  The ids grow
    # with the input, so they are never broadcast.
    wanted = reps.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", "doc_id", "text_key")
    wanted = wanted.select("rep", F.col("doc_id").alias("want"), F.col("text_key").alias("want_key")).hint("merge")
    texts = named.join(wanted, (F.col("text_key") == F.col("want_key")) & F.col("doc_id").eqNullSafe(F.col("want")))
    texts = materialize(texts.groupBy("rep").agg(F.min("text").alias("text")), "near_texts")

    def compared(parts):
        with_text = parts.join(texts, "rep").repartition("grp").sortWithinPartitions("grp", "rep")
        return materialize(tile_links(with_text, model, threshold, size), "near_links")

    crowd = buckets.agg(F.sum(F.col("n").cast("double") * F.col("n")), F.sum("n")).first()
    links = None
    if crowd[0] and crowd[0] > partners * crowd[1]:
        # Crowded buckets: first every member against its bucket's smallest, then
        # only buckets that are not one component yet.
        pairs = members.filter("rep <> low").select("rep", "low").distinct()
        sides = pairs.select(F.xxhash64("rep", "low").alias("grp"), F.explode(F.array("rep", "low")).alias("rep"))
        links = compared(sides)
        labels = connected_components(links)
        state = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").groupBy("bucket").agg(
            F.min(F.coalesce("component", "rep")).alias("x"), F.max(F.coalesce("component", "rep")).alias("y"))
        buckets = materialize(buckets.join(state.filter("x <> y").select("bucket"), "bucket"), "near_buckets")
    found = compared(tiled(members.select("bucket", "rep"), buckets, tile, TILE_WEIGHT))
    model.destroy()  # all that used it is written
    labels = connected_components(found if links is None else links.unionByName(found))
    copies = materialize(reps.join(labels, reps["rep"] == labels["node"], "left").select(
        "copy_a", "copy_b", "unnamed", F.col("doc_id").alias("copy_id"), "text_key",
        F.coalesce("component", "rep").alias("class")), "near_copies")
    classes = copies.groupBy("class").agg(F.min(F.struct("unnamed", "copy_id", "text_key")).alias("f")).select(
        "class", F.col("f.copy_id").alias("class_id"), F.col("f.text_key").alias("class_key"))
    return signed.select("doc_id", "text_key", "copy_a", "copy_b"), copies, classes


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                    tile: int = TILE, partners: int = PARTNERS) -> DataFrame:
    """doc_id and class_id (the smallest document of its group) of every row, and
    copy_id, the smallest document with the same words."""
    signed, copies, classes = _classes(docs, threshold, bands, rows, size, id_col, text_col, tile, partners)
    named = copies.join(classes, "class").select("copy_a", "copy_b", "copy_id", "class_id", F.lit(True).alias("grouped"))
    return signed.join(named, ["copy_a", "copy_b"], "left").select(
        "doc_id", F.when(F.col("grouped"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("grouped"), F.col("copy_id")).otherwise(F.col("doc_id")).alias("copy_id"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                      bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE, tile: int = TILE,
                      partners: int = PARTNERS) -> DataFrame:
    """``docs`` (same columns) with one row of each group: that of the smallest
    document (rows without an id come last).  Rows without words all stay; of rows
    equal in id and text one stays, the smallest by its other columns."""
    signed, copies, classes = _classes(docs, threshold, bands, rows, size, id_col, text_col, tile, partners)
    winner = classes.select(F.col("class_id").alias("_id"), F.col("class_key").alias("_key"))
    bare = signed.filter(F.col("copy_a").isNull()).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    mark, place = free_name(docs, "row_of"), free_name(docs, "text_of")
    keyed = docs.withColumn(mark, F.col(id_col).cast("long")).withColumn(place, F.xxhash64(text_col))

    def chosen(which):
        # One number for both columns: the rows are shuffled once, by it.
        return F.xxhash64(F.coalesce(which[0], F.lit(0)), which[0].isNull(), which[1])

    spot = free_name(docs, "spot")
    rows_ = keyed.withColumn(spot, chosen((F.col(mark), F.col(place))))
    kept = winner.select(chosen((F.col("_id"), F.col("_key"))).alias(spot), "_id", "_key").hint("merge")
    same = (rows_[mark].eqNullSafe(kept["_id"])) & (rows_[place] == kept["_key"])
    hit = rows_.join(kept, spot).filter(same)
    one = hit.groupBy(spot, "_id", "_key").agg(F.min(F.struct(*[F.col(c) for c in docs.columns])).alias(mark)).select(f"{mark}.*")
    without = bare.select("_key").distinct()
    stays = keyed.join(without, keyed[place] == without["_key"], "left_semi").select(*docs.columns)
    return one.unionByName(stays)
