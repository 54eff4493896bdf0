"""Small brute-force tests of the training-data operators, with the awkward
rows each must survive: nulls, empty texts, ties, repeats, clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import (bpe, collision_ann, packing, quality_gam, substring_dedup, token_files, toxicity_knn,
                          url_filter, vafile, weighted_minhash, wordhash)
from tickloom.llm.registry import URL_RULES, tokenizer_file

DOC = "doc_id long, text string"
ODD = ["", " ", None, "a  b", "It's, fine. É Été", "x <|endoftext|> y", "A. B, c\nd. e,  f.", "aaaa" * 700, "\tTab. ",
       "12,000 don't WE'RE!! 　 end"]


def words(n, seed):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 5000, n)]


def odd_docs(spark):
    return spark.createDataFrame(list(enumerate(ODD)), DOC)


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    path = tokenizer_file("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    ids = bpe.encode(odd_docs(spark), path)
    got = {r.doc_id: list(r.ids) for r in ids.collect()}
    back = {r.doc_id: r.text for r in bpe.decode(ids, path).collect()}
    sums = {r.doc_id: r for r in bpe.round_trip_digests(odd_docs(spark), path).collect()}
    for i, t in enumerate(ODD):
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i] == want and back[i] == (t or "")
        assert sums[i].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert sums[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer
    path = tokenizer_file("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    out = str(tmp_path / "tokens")
    token_files.write_tokens(odd_docs(spark), out, path, "<|endoftext|>", end_id=2)
    rows = {r.doc_id: r for r in token_files.with_crc(token_files.read_tokens(spark, out)).collect()}
    start = 0
    for i, t in enumerate(ODD):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        r = rows[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_files.read_tokens(spark, out, first=3, last=4).count() == 2


def test_packing_is_gapless_and_full(spark):
    pieces = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(
        np.random.default_rng(1).integers(1, 1025, 3000))], packing.PIECE_SCHEMA)
    seqs = {}
    for r in packing.pack(pieces).collect():
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        total += at
    assert len(seqs) <= 1.03 * total / 1024 + 1
    assert packing.cut_points(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]
    assert packing.cut_points(1024, 1024) == [(0, 1024)]


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n)[0] for n in (6, 7, 8)] == [0, 1, 2]  # 7 closed for 8
    assert bins.place(3)[0] == 0 and bins.place(2)[0] == 2


def test_token_pieces_of_awkward_texts(spark):
    rows = packing.token_pieces(odd_docs(spark), tokenizer_file("byte_bpe_50k.json"), "<|endoftext|>").collect()
    assert {r.doc_id for r in rows} == set(range(len(ODD)))
    assert [r.length for r in rows if r.doc_id in (0, 2)] == [1, 1]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


def test_searches_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    v = np.round(rng.standard_normal((300, 8)), 2).astype(np.float32)
    v[7] = v[8] = v[9]  # ties
    rows = [(i, x.tolist(), "c") for i, x in enumerate(v)]
    rows += [(5, v[5].tolist(), "c"), (400, None, "c"), (401, [float("nan")] * 8, "c"), (402, [], "c"),
             (None, v[0].tolist(), "c"), (403, [None] + [1.0] * 7, "c")]
    table = vectors(spark, rows)
    ints = np.floor(64 * v.astype(float)).astype(int)
    got = {}
    for r in vafile.top_k(vafile.scaled(table), lambda c: c % 20 == 0, 20, query_tile=4, candidate_tile=64).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 300, 20))
    for q, found in got.items():
        s = ints @ ints[q]
        best = [i for i in np.lexsort((np.arange(300), -s)) if i != q][:20]
        assert [found[k] for k in range(1, 21)] == [(i, s[i]) for i in best]
    near = collision_ann.search(table, lambda c: c % 20 == 0, 20, query_tile=4, candidate_tile=64).collect()
    exact = {q: {i for i in np.argsort(-(v.astype(float) @ v[q].astype(float)), kind="stable") if i != q} for q in got}
    hits = sum(r.vec_id in set([i for i in np.argsort(-(v.astype(float) @ v[r.query_id].astype(float)), kind="stable")
                                if i != r.query_id][:20]) for r in near)
    assert hits >= 0.9 * 20 * len(exact)


@pytest.mark.parametrize("longer, norm", [(1, 3.0), (20, 5.0), (200, 1e4), (1999, 2.0)])
def test_collision_search_of_mixed_norms(spark, longer, norm):
    rng = np.random.default_rng(8)
    v = rng.standard_normal((40, 32))[rng.integers(0, 40, 2000)] + 0.8 * rng.standard_normal((2000, 32))
    v /= np.sqrt((v * v).sum(1))[:, None]
    v[7: 7 + longer] *= norm
    v = v.astype(np.float32)
    table = vectors(spark, [(i, x.tolist(), "c") for i, x in enumerate(v)])
    near = collision_ann.search(table, lambda c: c % 20 == 0, 20).collect()
    score = v.astype(float) @ v.astype(float)[::20].T
    score[np.arange(0, 2000, 20), np.arange(100)] = -np.inf
    best = np.argsort(-score, axis=0)[:20]
    assert len(near) == 2000 and sum(r.vec_id in best[:, r.query_id // 20] for r in near) >= 0.99 * 2000


def test_chance_of_a_collision_holds_as_stated():
    for width in (2, 9):  # over the directions, for one vector
        half = collision_ann.reach(width, 2, 0.75, 0.9)
        least = int(np.ceil(0.75 * 2 * width))
        hits = [(np.abs(collision_ann.directions(width, 2, s)[0]) <= half).sum() >= least for s in range(4000)]
        assert abs(np.mean(hits) - 0.9) < 0.02


def test_searches_of_empty_tables(spark):
    empty = vectors(spark, [])
    assert vafile.top_k(vafile.scaled(empty), lambda c: c % 20 == 0, 20).count() == 0
    assert collision_ann.search(empty, lambda c: c % 20 == 0, 20).count() == 0


def naive_repeats(texts, window):
    first, gone = {}, {}
    split = {i: re.findall("[^\\x20\\x09-\\x0D]+", t or "") for i, t in texts}
    for i in sorted(split):
        for at in range(len(split[i]) - window + 1):
            key = tuple(split[i][at: at + window])
            if first.setdefault(key, (i, at)) != (i, at):
                gone.setdefault(i, set()).update(range(at, at + window))
    return {i: (len(w), " ".join(x for k, x in enumerate(w) if k not in gone.get(i, ()))) for i, w in split.items()}


def test_substring_dedup_equals_brute_force(spark):
    shared = " ".join(words(60, 1))
    texts = [(i, " ".join(words(80, i + 10)) + "\n" + shared + "\t" + " ".join(words(30, i + 50))) for i in range(12)]
    texts += [(20, texts[0][1]), (21, None), (22, ""), (23, "same " * 90), (24, "é　x " + shared)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], DOC + ", n_words int")
    rows = substring_dedup.remove_repeats(docs.select("doc_id", "text"), block_bytes=2000, shard_windows=100).collect()
    want = naive_repeats(texts, 20)
    assert {r.doc_id: (r.n_words, r.kept) for r in rows} == want
    stage = substring_dedup.without_repeats(docs)
    assert stage.columns == docs.columns  # n_words is the caller's own column and stage.count() == len(texts)
    assert substring_dedup.without_repeats(docs.limit(0)).count() == 0


def test_unlike_words_of_one_polynomial_hash_are_kept(spark):
    """Thue-Morse words and their mirror images agree under every polynomial
    hash with an odd base modulo 2^64."""
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    mirror = morse.translate(str.maketrans("ab", "ba"))
    some = words(19, 3)
    docs = spark.createDataFrame([(1, " ".join([*some, morse])), (2, " ".join([*some, mirror])), (3, " ".join([*some, morse]))], DOC)
    assert {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs).collect()} == {1: 0, 2: 0, 3: 20}
    got = weighted_minhash.near_duplicates(docs.filter("doc_id < 3"), threshold=0.99)
    assert {(r.doc_id, r.copy_id) for r in got.collect()} == {(1, 1), (2, 2)}


def test_span_hashes_depend_on_their_bytes_only():
    rng = np.random.default_rng(0)
    spans = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (0, 1, 7, 8, 9, 16, 17, 255, 256, 257, 700) for _ in range(4)]
    raw = np.frombuffer(b"".join(b"-" + s + b"+" for s in spans), np.uint8)
    size = np.array([len(s) for s in spans])
    starts = np.cumsum(size + 2) - size - 1
    for which in (0, 1):
        h = wordhash.span_hashes(raw, starts, starts + size, which)
        assert len(set(h.tolist())) == len(set(spans))
        for s, x in zip(spans, h):
            one = np.frombuffer(s, np.uint8)
            assert wordhash.span_hashes(one, np.array([0]), np.array([len(s)]), which)[0] == x


def jaccard(a, b):
    a, b = (set(zip(*[x.split()[k:] for k in range(5)])) for x in (a, b))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("partners", [512, 0])
def test_near_duplicates(spark, partners):
    base = words(200, 5)
    near = [" ".join(base[:k] + ["new" + str(k)] + base[k + 1:]) for k in range(10, 40, 3)]
    texts = [(i, t) for i, t in enumerate(near)]
    texts += [(50, near[0].upper() + "!"), (51, " ".join(words(200, 99))), (52, ""), (53, None), (54, "a b"),
              (55, "a b"), (56, " ".join(base[:100] + words(100, 77))), (None, near[0])]
    docs = spark.createDataFrame([(i, t, 7) for i, t in texts], DOC + ", class_id int")
    rows = weighted_minhash.near_duplicates(docs, partners=partners, tile=4).collect()
    got = {r.doc_id: r.class_id for r in rows}
    assert len(rows) == len(texts) and got[None] == 0
    assert all(got[i] == 0 for i in range(len(near))) and got[50] == 0
    assert got[51] == 51 and got[52] == 52 and got[53] == 53 and got[55] == got[54] == 54 and got[56] == 56
    kept = weighted_minhash.one_of_each_group(docs, partners=partners)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 51, 52, 53, 54, 56]
    assert weighted_minhash.near_duplicates(docs.limit(0)).count() == 0
    assert weighted_minhash.one_of_each_group(docs.limit(0)).count() == 0


def test_rows_without_or_with_a_repeated_id_are_documents_of_their_own(spark):
    a, b, c = (" ".join(words(60, k)) for k in (1, 2, 3))
    docs = spark.createDataFrame([(1, a), (1, b), (None, c), (None, c), (2, b.upper()), (None, None), (None, "")], DOC)
    rows = weighted_minhash.near_duplicates(docs).collect()
    assert sorted(map(str, ((r.doc_id, r.class_id) for r in rows))) == sorted(map(str, [
        (1, 1), (1, 1), (None, None), (None, None), (2, 1), (None, None), (None, None)]))
    kept = weighted_minhash.one_of_each_group(docs).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(map(str, [
        (1, a), (1, b), (None, c), (None, None), (None, "")]))


def test_every_pair_of_high_weighted_jaccard_is_joined(spark):
    """200 texts against brute force over the operator's own shingle weights."""
    rng = np.random.default_rng(12)
    bases = [words(90, 200 + k) for k in range(40)]
    texts = []
    for i in range(200):
        w = list(bases[i % 40])
        for at in rng.integers(0, 90, rng.integers(0, 7)):
            w[at] = f"w{rng.integers(0, 5000)}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), DOC)
    n, df = weighted_minhash.word_frequencies(docs)
    row, key, weight = weighted_minhash.shingles(weighted_minhash.Words(pa.array(texts)),
                                                 weighted_minhash.word_surprise(n, df), n, 5)
    bags = [dict(zip(key[row == i].tolist(), weight[row == i].tolist())) for i in range(200)]
    label = list(range(200))
    for i in range(200):
        for j in range(i):
            low = sum(min(x, bags[j][k]) for k, x in bags[i].items() if k in bags[j])
            if low >= 0.8 * (sum(bags[i].values()) + sum(bags[j].values()) - low):
                x, y = sorted((label[i], label[j]))
                label = [x if v == y else v for v in label]
    got = {r.doc_id: r.class_id for r in weighted_minhash.near_duplicates(docs).collect()}
    assert [got[i] for i in range(200)] == label and len(set(label)) < 180


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(2)
    key = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    w = rng.uniform(1, 9, 400)
    a, b = slice(0, 300), slice(100, 400)
    s = weighted_minhash.samples(np.concatenate([key[a], key[b]]), np.concatenate([w[a], w[b]]), np.array([0, 300]), 2000)
    assert abs((s[0] == s[1]).mean() - w[100:300].sum() / w.sum()) < 0.04


def test_url_filter(spark):
    pages = [
        (1, "http://A.Example.com/de/x?q", "<link rel='canonical' href='http://alias.org/p'>"),
        (2, "https://alias.org/p#top", None),
        (3, "http://alias.org/q", "<META http-equiv=refresh content=\"0; url=/p\">"),
        (4, "https://x.example.net/en/1", ""), (5, "http://x.net/1", "<p>"), (6, None, None), (7, "no scheme", "x"),
        (8, "http://mixed.org/r", "<link href=\"http://e.example.com/de/\" rel=canonical><link rel=canonical href=//f.org/fr/1>"),
        (9, "http://net", "<link rel=canonical href=self>")]
    table = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(table, URL_RULES).collect()}
    assert got[1] == ("a.example.com", "/de/x", "example.com/de/", "block")
    assert got[2][2:] == (None, "block") and got[3][2:] == (None, "block")
    assert got[4][2:] == ("example.net/en/", "allow") and got[5][2:] == ("net/", "block")
    assert got[6] == ("", "", None, "allow") and got[7] == ("", "", None, "allow")
    assert got[8][3] == "allow"  # an allowed alias outweighs a blocked one
    assert got[9] == ("net", "", None, "block")  # no rule fits an empty path; its alias net/self is blocked
    assert url_filter.judge(table.limit(0), URL_RULES).count() == 0


def test_refresh_urls_are_read_whole(spark):
    contents = ['content="0; url=http://a.org/p?x=1&amp;y=2"', "content='0;URL=http://a.org/p;v=1?x=1;y=2'",
                "content=\"0; url='http://a.org/p?x=1&amp;y=2;z=3'\"", "content=0;url=http://a.org/p?x=1&amp;y=2;z=4",
                'content="0; url = http://a.org/p;w " id="url=/q"', "content=0; url=/p;u"]
    pages = [(f"http://b.org/{i}", f"<meta http-equiv='refresh' {c}>") for i, c in enumerate(contents)]
    edges = url_filter.alias_edges(spark.createDataFrame(pages, "url string, html string")).collect()
    assert {r.a: r.b for r in edges} == {
        "b.org/0": "a.org/p?x=1&y=2", "b.org/1": "a.org/p;v=1?x=1;y=2", "b.org/2": "a.org/p?x=1&y=2;z=3",
        "b.org/3": "a.org/p?x=1&y=2;z=4", "b.org/4": "a.org/p;w", "b.org/5": "b.org/p;u"}


TAGS = [
    ('<link rel="canonical" data-href="/wrong" href="/right">', "b.org/right"),      # whole attribute names
    ('<link data-href="/wrong" rel=canonical href=/right>', "b.org/right"),
    ('<link rel="alternate canonical" href="/p">', "b.org/p"),                       # a list of words
    ('<link title="a > b" rel="canonical" href="/p">', "b.org/p"),                   # ">" inside quotes
    ('<base href="http://c.org/d/"><link rel=canonical href=e>', "c.org/d/e"),       # a base moves relative links
    ('<base href="/d/x"><link rel=canonical href="e?f=1&#38;g=2">', "b.org/d/e?f=1&g=2"),
    ('<link rel="canonicalish" href="/p">', None),
    ('<!-- <link rel="canonical" href="/p"> -->', None),
    ('<script>"<link rel=canonical href=/p>"</script>', None),
    ('<link href="/p?x=1&#x26;y=2&amp;z=3" rel="CANONICAL">', "b.org/p?x=1&y=2&z=3"),
    ("<LINK REL='canonical' HREF=' http://C.org/p '>", "c.org/p"),
    ('<a rel="canonical" href="/p">', None),
    ('<link rel=canonical href="">', None),
    ('<meta http-equiv=" Refresh " content="5">', None),
    ('<meta name="refresh" content="0; url=/p">', None),
    ('<meta http-equiv="refresh" content="0; url=//c.org/p"/>', "c.org/p"),
    ('<link rel=canonical href=//net/x>', "net/x"),
    (None, None), ("", None), ("<link rel=canonical href=/p", None)]


def test_links_are_read_attribute_by_attribute(spark, tmp_path):
    import duckdb
    from tickloom.llm.registry import OP3_SQL
    pages = [(i, f"http://b.org/{i}", html) for i, (html, _) in enumerate(TAGS)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    edges = {r.a: r.b for r in url_filter.alias_edges(table.select("url", "html")).collect()}
    assert edges == {f"b.org/{i}": to for i, (_, to) in enumerate(TAGS) if to is not None}
    more = [(100 + i, f"http://{h}", f'<link rel="x canonical" href="//{to}">') for i, (h, to) in enumerate(
        [("c.org/p", "example.com/de/z"), ("c.org/d/e", "f.org/fr/1"), ("b.org/p", "x.net/1"), ("b.org/right", "c.org/p")])]
    both = spark.createDataFrame(pages + more, "page_id long, url string, html string")
    both.write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = sorted(con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({OP3_SQL})").fetchall())
    got = sorted(tuple(r) for r in url_filter.judge(both, URL_RULES).collect())
    assert got == want and {r[4] for r in got} == {"allow", "block"}


def labelled(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(400):
        text = words(60, 1000 + i)
        toxic, good = int(i % 5 == 0), int(i % 4 != 0)
        if toxic:
            text[rng.integers(0, 60)] = ["idiot.", "Moron"][i // 10 % 2]
        rows.append((i, " ".join(text) if good else " ".join(x.upper() + "!!" for x in text), "score"))
        labels.append((i, good, toxic))
    rows += [(900, None, "s"), (901, "", "s"), (902, "idiot", "s"), (0, rows[0][1], "s")]
    return (spark.createDataFrame(rows, DOC + ", score string"),
            spark.createDataFrame(labels + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"), labels)


def test_classifiers_learn_and_survive(spark):
    docs, labels, truth = labelled(spark)
    wanted = F.col("doc_id") % 2 == 0
    named = docs.select("doc_id", "text")
    quality = quality_gam.with_quality(named, quality_gam.learn(docs, labels, wanted)).collect()
    toxicity = toxicity_knn.with_toxicity(named, toxicity_knn.learn(docs, labels, wanted)).collect()
    good = {i: g for i, g, _ in truth}
    bad = {i: t for i, _, t in truth}
    assert len(quality) == len(toxicity) == docs.count()
    assert np.mean([(r.score >= 0.5) == good[r.doc_id] for r in quality if r.doc_id in good]) > 0.97
    assert np.mean([(r.score >= 0.5) == bad[r.doc_id] for r in toxicity if r.doc_id in bad]) > 0.97
    told = {r.doc_id: r for r in toxicity}
    assert told[902].score > 0.5 and told[902].evidence[0].similarity > 0
    assert told[900].score < 0.5 and told[901].evidence == []
    assert all(0 <= r.score <= 1 for r in quality + toxicity)
    none = labels.limit(0)
    assert {r.score for r in quality_gam.with_quality(named, quality_gam.learn(docs, none, wanted)).collect()} == {0.5}
    assert {r.score for r in toxicity_knn.with_toxicity(named, toxicity_knn.learn(docs, none, wanted)).collect()} == {0.0}


def test_copies_of_a_toxic_text_count_once(spark):
    docs, labels, truth = labelled(spark)
    docs = docs.filter("doc_id < 400").select("doc_id", "text")
    copied = " ".join([*words(60, 1000), "idiot"])
    more = [(2000 + 2 * i, copied.upper() if i % 2 else copied + ".") for i in range(200)]  # half as many as the others
    docs = docs.union(spark.createDataFrame(more, DOC))
    labels = labels.union(spark.createDataFrame([(i, 0, 1) for i, _ in more], labels.schema))
    model = toxicity_knn.learn(docs, labels, F.col("doc_id") % 2 == 0)
    assert len(model["ids"]) == 201 and model["prior"] == 41 / 201  # 200 texts, 40 of them toxic, and the copied one
    bad = {i: t for i, _, t in truth}
    got = {r.doc_id: r.score >= 0.5 for r in toxicity_knn.with_toxicity(docs, model).collect() if r.doc_id in bad}
    assert np.mean([got[i] for i in bad if bad[i]]) >= 0.9 and np.mean([got[i] for i in bad if not bad[i]]) < 0.05


def test_block_max_index_is_exact():
    rng = np.random.default_rng(6)
    dense = rng.random((500, 40)) * (rng.random((500, 40)) < 0.1)
    dense[:, 0] += 0.01
    dense /= np.sqrt((dense ** 2).sum(1))[:, None]
    row, term = np.nonzero(dense)
    index = toxicity_knn.Index(np.arange(40, dtype=np.uint64), np.ones(40), np.searchsorted(row, np.arange(501)), term,
                               dense[row, term])
    for q in range(0, 500, 50):
        t = np.flatnonzero(dense[q])
        for without in (-1, q):
            near, sim = index.nearest(t, dense[q, t], 15, without)
            exact = dense @ dense[q]
            exact[without] = -1 if without >= 0 else exact[without]
            assert np.allclose(sim, np.sort(exact)[::-1][:15]) and without not in near


def test_toxicity_equals_brute_force(spark):
    docs, labels, _ = labelled(spark)
    named = docs.select("doc_id", "text").filter("doc_id < 120 OR doc_id >= 900")
    wanted = F.col("doc_id") % 2 == 0
    texts = {r.doc_id: re.findall("[0-9a-z\x80-\U0010ffff]+", (r.text or "").lower()) for r in named.collect()}
    toxic = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and r.doc_id is not None}
    examples = {}
    for i in sorted(toxic):
        if i in texts and i % 2 == 0:
            examples.setdefault(tuple(texts[i]), []).append(i)
    names = [min(v) for v in examples.values()]
    label = np.array([float(np.mean([toxic[i] for i in v]) >= 0.5) for v in examples.values()])
    vocabulary = sorted({w for t in examples for w in t})
    copies = {}
    for t in texts.values():
        copies[tuple(t)] = copies.get(tuple(t), 0) + 1
    df = {w: sum(w in t for t in map(set, copies)) for w in vocabulary}  # copies count once
    held = {w: [sum(y for t, y in zip(examples, label) if w in t), sum(1 - y for t, y in zip(examples, label) if w in t)]
            for w in vocabulary}
    weight = {w: (np.log((1 + len(copies)) / (1 + df[w])) + 1e-3) * np.log2(2 + held[w][0] / max(1, held[w][1])) for w in vocabulary}

    def vector(words_):
        v = np.array([(1 + np.log(words_.count(w))) * weight[w] if w in words_ else 0.0 for w in vocabulary])
        return v / max(np.sqrt((v * v).sum()), 1e-300)

    matrix = np.array([vector(list(t)) for t in examples])
    model = toxicity_knn.learn(named, labels, wanted)
    for r in toxicity_knn.with_toxicity(named, model, k=5).collect():
        sim = matrix @ vector(texts[r.doc_id])
        best = np.sort(sim)[::-1][:5]
        assert np.allclose([e.similarity for e in r.evidence], best[best > 0][:3], atol=1e-9)
        near = np.flatnonzero(sim >= best[-1] - 1e-12)
        if len(near) == 5 and best[-1] > 0:  # no ties at the edge
            square = sim[near] ** 2
            raw = ((square * label[near]).sum() + 0.25 * square.mean() * label.mean()) / (square.sum() + 0.25 * square.mean())
            assert abs(r.score - toxicity_knn.calibrated(raw, model["cut"])) < 1e-9
            assert {e.doc_id for e in r.evidence} <= {names[i] for i in near}


def test_the_cut_has_the_best_f1():
    raw = np.array([0.9, 0.8, 0.8, 0.4, 0.3, 0.1])
    cut = toxicity_knn.best_cut(raw, np.array([1, 1, 0, 1, 0, 0.0]))
    assert 0.3 < cut < 0.4 and toxicity_knn.calibrated(cut, cut) == 0.5 and toxicity_knn.calibrated(1.0, cut) == 1.0


def test_clashing_names_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b", 0.5)], DOC + ", Score double")
    with pytest.raises(ValueError, match="Score|score"):
        toxicity_knn.with_toxicity(docs, {"empty": True})
    out = toxicity_knn.with_toxicity(docs, {"empty": True}, score_col="toxicity").first()
    assert out.Score == 0.5 and out.toxicity == 0.0 and out.evidence == []
    with pytest.raises(ValueError, match="text"):
        substring_dedup.remove_repeats(docs, kept_col="Text")


def test_text_statistics_of_empty_texts():
    x = quality_gam.text_features(pa.array(["", "a b b\nA!"]))
    assert x.shape == (2, len(quality_gam.FEATURES)) and not x[0].any() and np.isfinite(x).all()


def test_library_encoder_gives_the_ids_of_whole_texts():
    from tickloom.llm.registry import tokenizer_file
    from tickloom.llm.tokens import LibraryEncoder
    texts = ["", " ", "a  b", "a\n b", " a", "a ", "it's <|endoftext|> x", "x < y <| z", "é .  x",
             "x　 y z\n", "\x1c \x1f a", "one two\nthree. four", "w" * 3000 + " " + "b" * 1500 + " c", "one two"]
    encoder = LibraryEncoder(tokenizer_file("byte_bpe_50k.json"), "<|endoftext|>", True)
    expected = [e.ids for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for batch in ([[t] for t in texts], [texts], [texts[::-1]]):
        for some in batch:
            ids, ends = encoder.encode(pa.array(some, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [expected[texts.index(t)] for t in some]


def test_token_files_are_read_without_moving_ids(spark, tmp_path, capsys):
    out = str(tmp_path / "tokens")
    token_files.write_tokens(odd_docs(spark), out, tokenizer_file("word_bpe_49k.json"), "<|endoftext|>", end_id=2)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large files
    try:
        rows = token_files.read_tokens(spark, out)
        rows.explain()
        plan = capsys.readouterr().out
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert [r.n_tokens for r in rows.orderBy("doc_id").collect()][:2] == [1, 1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_full_chunk_store_keeps_what_was_met_again():
    from tickloom.llm.tokens import LibraryEncoder
    for name, keeps_spaces in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        encoder = LibraryEncoder(tokenizer_file(name), "<|endoftext|>", keeps_spaces, 400)
        for i in range(8):
            texts = ["one two three", " ".join(words(150, i)), "a\n b", "one two three " + " ".join(words(150, i))]
            ids, ends = encoder.encode(pa.array(texts))
            expected = [e.ids for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == expected
            assert len(encoder.start) <= 800
            if i:
                assert encoder.again[encoder.index["one"]]  # an emptied store has not met it again


def test_capitals_before_combining_marks_are_encoded_as_the_library_does():
    from tickloom.llm.tokens import LibraryEncoder
    encoder = LibraryEncoder(tokenizer_file("word_bpe_49k.json"), "<|endoftext|>", False)
    for text in ("J̌ x", "ab T̈ c", "H̱́", "É J", "Ẉ̊ Y̊", "A, B́. c"):
        assert encoder.encode(pa.array([text]))[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
