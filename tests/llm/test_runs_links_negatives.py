"""Brute-force tests of periodic runs, SimHash links and hard negatives."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

from tickloom.llm import hard_negatives, periodic_runs, registry, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string"


def runs_of(x, min_length=6, min_copies=4):
    """Every run (start, length, period), period by period."""
    out = []
    for q in range(1, len(x) // min_copies + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            s = x[i: j + q]
            if len(s) >= max(min_length, min_copies * q) and not any(s[r:] == s[:-r] for r in range(1, q)):
                out.append((i, len(s), q))
            i = j
    return sorted((s, n, q) for s, n, q in out)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def run_row(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = runs_of(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = None
    for r in runs:
        if top is None or r[1] * top[2] > top[1] * r[2]:
            top = r
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (
        "".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, *sha)


def odd_texts():
    rng = np.random.default_rng(5)
    texts = ["", None, " ", "a", "a a a a a", "a a a a a a", "x " * 700, "a b " * 9 + "a", "b a\ta\na a a a a a c",
             "ab c a bc " * 5, "É é " * 8, "a b a b " * 6]
    for _ in range(120):
        parts = [list(map(str, rng.integers(0, rng.integers(1, 4), rng.integers(1, 30)))) * int(rng.integers(1, 7))
                 for _ in range(rng.integers(1, 4))]
        texts.append(" ".join(sum(parts, [])))
    return texts


def test_runs_equal_brute_force(spark, tmp_path, monkeypatch):
    rows = [*enumerate(odd_texts()), (None, "q q q q q q q"), (3, "repeated id"), (3, "repeated id")]
    spark.createDataFrame(rows, DOC).write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.op11_periodic_runs(spark, str(tmp_path)).collect()
    order = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got), key=order) == sorted((run_row(*r) for r in rows), key=order)


def test_runs_keep_columns_and_slices():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 3, n) for n in (0, 5, 300, 0, 64, 2000)]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, s, n, q = periodic_runs.find_runs(np.concatenate(texts), first)
    for i, t in enumerate(texts):
        got = [x for x in zip(s[text == i].tolist(), n[text == i].tolist(), q[text == i].tolist())]
        assert got == runs_of(t.tolist())
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(9, np.int64), np.array([0, 9]), min_copies=2)


def test_transform_inverts_and_convolves():
    rng = np.random.default_rng(0)
    for size in (2, 4, 32):
        power = periodic_runs.roots(size)
        a, b = (rng.integers(0, periodic_runs.PRIME, (3, size)) for _ in range(2))
        assert (periodic_runs.inverse(periodic_runs.transform(a, power), power) == a).all()
        c = periodic_runs.inverse(periodic_runs.transform(a, power) * periodic_runs.transform(b, power)
                                  % periodic_runs.PRIME, power)
        want = [sum(int(a[1, i]) * int(b[1, (k - i) % size]) for i in range(size)) % periodic_runs.PRIME
                for k in range(size)]
        assert c[1].tolist() == want


def test_runs_of_an_empty_table_and_clashing_names(spark):
    assert periodic_runs.with_runs(spark.createDataFrame([], DOC)).count() == 0
    docs = spark.createDataFrame([(1, "a a a a a a b", 7)], DOC + ", runs int")
    r = periodic_runs.with_runs(docs, runs_col="found").first()
    assert (r.runs, [tuple(x) for x in r.found], r.collapsed) == (7, [(0, 6, 1)], "a b")


def fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i: i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, prints, bits):
    least = list(range(len(ids)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                least[max(root(i), root(j))] = min(root(i), root(j))
    named = {}
    for i, x in enumerate(ids):
        if x is not None:
            named[root(i)] = min(x, named.get(root(i), x))
    return [named.get(root(i)) for i in range(len(ids))]


def test_simhash_components_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 400, 300)]
    texts = ["", None, "a b", "A B", "É b c d e", "a b c d", "a b c d", "a b c e"]
    for i in range(150):
        w = list(base) if i % 3 else [f"w{x}" for x in rng.integers(0, 400, 40)]
        for at in rng.integers(0, len(w), rng.integers(0, 5)):
            w[at] = "edit"
        texts.append(" ".join(w).upper() if i % 7 == 0 else "\t".join(w))
    ids = [None if i == 4 else 2 if i in (2, 9) else i for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, 0) for i, t in zip(ids, texts)], DOC + ", print int")
    prints = [fingerprint(t) for t in texts]
    want = sorted(zip([str(i) for i in ids], [f"{p:016x}" for p in prints], map(str, components(ids, prints, 4))))
    for tile in (simhash.TILE, 5):
        got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id))
                     for r in simhash.near_duplicates(docs, tile=tile).collect())
        assert got == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_links_join_dense_groups():
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    prints = np.unique([c ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 6))))
                        for c in centre for _ in range(70)])
    group = np.sort(rng.integers(0, 4, len(prints)))
    for side in (np.zeros(len(prints), np.int64), rng.integers(0, 2, len(prints))):
        a, b = simhash.links_of(group, side, prints, 4, 32)
        label = np.arange(len(prints))
        simhash.join_labels(label, a, b)
        want = np.arange(len(prints))
        for g in range(4):
            rows = np.flatnonzero(group == g)
            across = side[rows].any()
            near = np.bitwise_count(prints[rows][:, None] ^ prints[rows]) <= 4
            if across:
                near &= side[rows][:, None] != side[rows]
            i, j = np.nonzero(near)
            simhash.join_labels(want, rows[i], rows[j])
        assert (label == want).all()


def negatives(rows, step=100, positives=5, many=10):
    out = []
    for a, la, va in rows:
        if a % step:
            continue
        score = sorted((-int(np.dot(va, v)), i, x) for i, x, v in rows if i != a)
        for ps, p, _ in [s for s in score if s[2] == la][:positives]:
            fits = [s for s in score if s[2] != la and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:many]
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i, _) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("scale", [40, 1 << 29])
def test_hard_negatives_equal_brute_force(spark, scale):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(420):
        v = [int(x) for x in np.floor(rng.normal(0.4, 1, 12) * scale)]
        rows.append((i, int(rng.integers(0, 4)), rows[-1][2] if i % 9 == 5 else v))
    odd = [(1000, None, [1] * 12), (1100, 1, None), (None, 1, [1] * 12), (1200, 1, [None] + [1] * 11), (7, rows[7][1], rows[7][2])]
    schema = "vec_id long, label int, vec array<long>, score int"
    table = spark.createDataFrame([(*r, 0) for r in rows + odd], schema)
    want = negatives([(i, x, np.array(v, dtype=object)) for i, x, v in rows], 20, 5, 6)
    for sizes in ({}, {"anchor_tile": 5, "candidate_tile": 60, "group": 2}):
        got = hard_negatives.mine(table, lambda c: c % 20 == 0, negatives=6, **sizes)
        assert sorted(map(tuple, got.collect())) == want
    assert hard_negatives.mine(table.limit(0), lambda c: c % 20 == 0).count() == 0


def test_segment_bounds_hold():
    rng = np.random.default_rng(1)
    m = rng.integers(-300, 300, (200, 13))
    exact = m @ m.T
    at = 0
    means, deviations = hard_negatives.summaries(m, (3, 13))
    for n in (3, 13):
        part = slice(at, at + n)
        at += n
        middle, spread = means[:, part] @ means[:, part].T, deviations[:, part] @ deviations[:, part].T + 1e-6
        assert (middle - spread <= exact).all() and (exact <= middle + spread).all()
