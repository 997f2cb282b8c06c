"""Repeats, the n-gram join, near vectors and components against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tabularium import session
from tabularium.llm import components, near_vectors, ngram_join, queries, suffix_repeats
from tabularium.llm.hashing import shingle_hashes, word_hashes

FOLDER = "/root/testdata/sf0.001"


def reach(keys, links):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def test_components_by_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(60)] + [(700, i) for i in range(701, 900)] + [(1, 1), (None, 4)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components.connected(df, "a", "b").collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == reach({x for p in real for x in p}, real)
    assert components.connected(df.limit(0), "a", "b").collect() == []


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles_of(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_shingles():
    for text in ["", " \t", "a", "A b", "x y z u v", "É é a b c d e f", "a a a a a a a", "\x0ba\x0cb\rc d e f", "a b c d e f " * 50]:
        assert len(shingle_hashes(text)) == len(shingles_of(text))
        assert len(word_hashes(np.frombuffer(text.encode(), np.uint8))) == len(words_of(text))
    assert (shingle_hashes("A B c d e f") == shingle_hashes(" a b\nC d e F ")).all()


def jaccard_by_brute_force(rows):
    sets = [(k, shingles_of(t)) for k, t in rows]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    comp = reach([k for k, _ in sets], links)
    return sorted((k, len(s), comp[k]) for k, s in sets)


def edited(rng, words, share):
    return [rng.choice("pqrstuvw") + w if rng.random() < share else w for w in words]


def test_jaccard_join_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", 1)
    rng = random.Random(5)
    rows = []
    for _ in range(12):
        base = [rng.choice("abcdefgh") + str(rng.randrange(60)) for _ in range(rng.randrange(1, 160))]
        for share in [0, 0, 0.005, 0.01, 0.02, 0.03, 0.05] * 2:
            rows.append(" ".join(edited(rng, base, share)))
    line = " ".join(f"c{i}" for i in range(40))
    rows += [line + " " + " ".join(str(rng.random()) for _ in range(rng.randrange(14))) for _ in range(60)]
    rows += ["", None, "  ", "one", "One", "one two", "x " * 4000, "y z " * 3000]
    keyed = [(i * 7 % 1009, t) for i, t in enumerate(rows)]
    df = spark.createDataFrame(keyed, "doc_id long, text string").withColumnRenamed("other", "node")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, "doc_id", "text").collect())
    assert got == jaccard_by_brute_force(keyed)
    monkeypatch.setattr(ngram_join, "GROUP", 7)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df.repartition(5), "doc_id", "text").collect()) == got


def test_jaccard_query_and_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in queries.ngram_jaccard(spark, FOLDER).collect())
    assert got == jaccard_by_brute_force(rows)
    df = spark.createDataFrame([(None, "a b c d e f", 1), (5, "a b c d e f", 2), (5, "a b c d e f", 2), (6, "z", 3)], "doc_id long, text string, component_id long")
    assert sorted((str(r.doc_id), r.component_id) for r in ngram_join.jaccard_components(df, "doc_id", "text").collect()) == [("5", 5), ("5", 5), ("6", 6), ("None", 5)]
    assert ngram_join.jaccard_components(df.limit(0), "doc_id", "text").collect() == []


def test_filters_keep_similar_pairs():
    rng = np.random.default_rng(2)
    for _ in range(600):
        base = rng.integers(0, 1 << 60, rng.integers(1, 300), dtype=np.uint64)
        other = np.concatenate([base[rng.random(len(base)) < 0.9], rng.integers(0, 1 << 60, rng.integers(0, 4), dtype=np.uint64)])
        a, b = np.unique(base), np.unique(other)
        both = len(np.intersect1d(a, b))
        assert ngram_join.similar(a, b, 80) == (len(b) > 0 and 100 * both >= 80 * (len(a) + len(b) - both))
        if ngram_join.similar(a, b, 80):
            assert ngram_join.may_be_similar(len(a), ngram_join.signature(a), len(b), ngram_join.signature(b), 80)
        assert ngram_join.least_overlap(len(a), len(b), 80) == next(o for o in range(999) if 100 * o >= 80 * (len(a) + len(b) - o))


def repeats_by_brute_force(texts, length):
    seen = defaultdict(list)
    datas = [(t or "").encode() for t in texts]
    for i, d in enumerate(datas):
        for p in range(len(d) - length + 1):
            seen[d[p:p + length]].append((i, p))
    out = [np.zeros(len(d), bool) for d in datas]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                out[i][p:p + length] = True
    return [(len(d), int(m.sum()), int((np.diff(np.r_[0, m.astype(int)]) == 1).sum()), bytes(np.frombuffer(d, np.uint8)[~m])) for d, m in zip(datas, out, strict=True)]


def passages(rng, alphabet, length, n):
    parts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(length // 2, 3 * length))) for _ in range(8)]
    texts = []
    for _ in range(n):
        pieces = []
        for _ in range(rng.randrange(1, 5)):
            part = rng.choice(parts)
            a = rng.randrange(len(part) // 2)
            pieces.append(part[a:a + rng.randrange(length // 2, 3 * length)])
            pieces.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(length))))
        texts.append("".join(pieces))
    return texts


@pytest.mark.parametrize(("length", "alphabet", "leaves"), [(400, "abcdefghij é", 40), (40, "ab", 4), (40, "ab", 1000), (24, "a", 40), (64, "ab😀", 100)])
def test_repeats_by_brute_force(spark, monkeypatch, length, alphabet, leaves):
    monkeypatch.setattr(suffix_repeats, "LEAVES", leaves)
    monkeypatch.setattr(suffix_repeats, "PART_LEAVES", 40)
    rng = random.Random(length)
    texts = passages(rng, alphabet, length, 60) + ["", None, "x", "ab" * (2 * length), "q" * length, "r" * (length + 1)]
    texts += texts[:3]
    df = spark.createDataFrame([(i // 2, t, "v") for i, t in enumerate(texts)], "doc_id long, text string, version string").repartition(6)
    got = suffix_repeats.remove_repeats(df, "doc_id", "text", length).collect()
    want = repeats_by_brute_force(texts, length)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in got) == sorted((i // 2, *w) for i, w in enumerate(want))


def test_repeats_in_pieces(monkeypatch):
    rng = random.Random(1)
    data = "".join(rng.choice("abc") for _ in range(5000)).encode()
    whole = suffix_repeats.anchors(data, 50)
    monkeypatch.setattr(suffix_repeats, "PIECE", 333)
    assert all((a == b).all() for a, b in zip(whole, suffix_repeats.anchors(data, 50), strict=True))


def test_repeats_query_and_empty(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    want = dict(zip(docs, repeats_by_brute_force(docs.values(), 400), strict=True))
    rows = queries.suffix_dedup(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, removed, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, hashlib.sha256(kept).hexdigest())
    assert suffix_repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").collect() == []


def vectors_by_brute_force(rows, threshold=0.95):
    ok = [(k, np.array(v, float)) for k, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for i, (a, x) in enumerate(ok):
        for b, y in ok[:i]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links.append((a, b))
    comp = reach([k for k, _ in rows], links)
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return sorted((k, n[k], comp[k], comp[k] == k) for k, _ in rows)


def test_vectors_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 60)
    monkeypatch.setattr(near_vectors, "TILE", 32)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 20))
    rows = [(i, (centres[i % 12] + rng.normal(size=20) * 0.15).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rng.normal(size=20).astype(np.float32).tolist()) for i in range(100)] + [(500 + i, rows[3][1]) for i in range(40)]
    rows += [(600, None), (601, [0.0] * 20), (602, [float("nan")] * 20), (603, [1.0, None]), (604, []), (605, [1.0, 2.0]), (606, [2.0, 4.0]), (607, [float("inf")] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(df, "vec_id", "embedding").collect())
    assert got == vectors_by_brute_force(rows)
    assert near_vectors.near_vectors(df.limit(0), "vec_id", "embedding").collect() == []


def test_vectors_are_dealt_in_bounded_batches(spark, monkeypatch):
    """A batch of rows that go to many blocks leaves in parts; before, it left as one batch of rows times blocks."""
    for name, value in {"BLOCK": 10, "BLOCKS": 12, "DEALT_BYTES": 20_000}.items():
        monkeypatch.setattr(near_vectors, name, value, raising=False)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    steps, own = [], type(df).mapInArrow

    def kept(frame, step, *more):
        steps.append(step)
        return own(frame, step, *more)

    monkeypatch.setattr(type(df), "mapInArrow", kept)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(df, "vec_id", "embedding", 0.8).collect())
    assert got == vectors_by_brute_force(rows, 0.8)
    along, deal = steps[-2:]
    batch = pa.RecordBatch.from_pydict({"v": np.arange(150), "copies": np.ones(150, int), "vector": pa.array([v for _, v in rows], pa.list_(pa.float32()))})
    sizes = [b.num_rows for b in deal(along(iter([batch])))]
    assert sum(sizes) > 1000 and max(sizes) * (12 * 4 + 48) <= 20_000


def test_close_vectors_are_paired_in_bounded_memory():
    """2,000 vectors that all link: their pairs are decided and given part by part, not a tile at a time."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=64) + rng.normal(size=(2000, 64)) * 0.05
    x = x[np.argsort((x / np.linalg.norm(x, axis=1, keepdims=True))[:, 0])]
    n = 0
    tracemalloc.start()
    try:
        for r, c in near_vectors.near(x, x, np.eye(64), 0.95, True):
            assert (r < c).all() and len(r) == len(c)
            n += len(r)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 2000 * 1999 // 2 and peak < 200 << 20


def test_vectors_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in queries.near_embeddings(spark, FOLDER).collect())
    assert got == vectors_by_brute_force(rows)


def test_chain_of_near_copies(spark):
    """2,000 texts, each a few words further from the first: neighbours link, ends do not, so no pivot meets all."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(2000):
        if i % 2:
            words[rng.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(3000 + i, " ".join([*words[:60], *(f"y{rng.random()}" for _ in range(60))])) for i in range(50)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect())
    near = [(k, shingles_of(t)) for k, t in rows]
    links = [(a, b) for i, (a, x) in enumerate(near) for b, y in near[max(0, i - 60):i] if 100 * len(x & y) >= 80 * len(x | y)]
    comp = reach([k for k, _ in near], links)
    assert got == sorted((k, len(s), comp[k]) for k, s in near)


def test_near_copies_make_each_pair_once(spark, monkeypatch):
    """Nodes of a group of near copies meet in many shingles; a pair is made in the first of them only."""
    rng = random.Random(21)
    places = {node: [p for p in range(14) if rng.random() < 0.85] for node in range(90)}
    rows = spark.createDataFrame([(100 + p, node, node, 100, at) for node, mine in places.items() for at, p in enumerate(mine)],
                                 "shingle long, component long, node long, n int, place int")
    mark = ngram_join.signature(np.arange(100, dtype=np.uint64))
    nodes = spark.createDataFrame([(node, bytearray(mark)) for node in places], "node long, mark binary")
    monkeypatch.setattr(type(rows), "distinct", lambda df: df)
    for size in (2000, 7):
        monkeypatch.setattr(ngram_join, "GROUP", size)
        got = [(r.a, r.b) for r in ngram_join._across(rows, nodes, 80).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(a, b) for a, x in places.items() for b, y in places.items() if a > b and set(x) & set(y)}


def test_intermediate_folders_go(spark, monkeypatch):
    """Once an operator has its components or spans, what it wrote on the way is gone from the shared folder."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    rows = spark.createDataFrame([(i, " ".join(edited(rng, words, 0.01 * (i % 4)))) for i in range(60)], "doc_id long, text string")
    before, gone = len(session._made), []
    monkeypatch.setattr(session, "_remove", lambda spark, path, remove=session._remove: (remove(spark, path), gone.append(path.removeprefix("file:"))))
    assert ngram_join.jaccard_components(rows, "doc_id", "text").count() == 60
    assert suffix_repeats.remove_repeats(rows, "doc_id", "text", 100).where("n_removed > 0").count() > 50
    assert sorted(path.rsplit("/", 1)[1][:-33] for _, path in session._made[before:]) == ["components", "repeat-spans", "shingle-nodes", "shingle-sets"]
    assert len(gone) > 10 and not any(path.exists() for path in map(Path, gone))


def test_open_rows_are_those_with_another_component_of_a_length_in_reach(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(12), rng.randrange(3), i, rng.choice([5, 8, 10, 40, 50, 63, 200, 256, 4000]), 0) for i in range(80)]
    df = spark.createDataFrame(rows, "shingle long, component long, node long, n int, place int")
    got = {r.node for r in ngram_join._open_rows(df, 80).collect()}
    need = {a[2] for a in rows if any(a[0] == b[0] and a[1] != b[1] and 100 * min(a[3], b[3]) >= 80 * max(a[3], b[3]) for b in rows)}
    mixed = {a[2] for a in rows if any(a[0] == b[0] and a[1] != b[1] for b in rows)}
    assert need <= got < mixed


def test_texts_are_shuffled_only_if_wanted(spark):
    keys = spark.createDataFrame([(k,) for k in [None, 0, -7, 2**62, *range(100, 300)]], "k long")
    every = keys.union(spark.range(10_000, 60_000))
    may = ngram_join._may_be_among(keys, "k")
    passed = [r.k for r in every.where(may(every["k"])).collect()]
    assert len(passed) < 230 and {r.k for r in keys.collect()} <= set(passed)
    assert not spark.range(5).where(ngram_join._may_be_among(keys.limit(0), "k")("id")).count()


def test_pipeline_join_reads_texts_where_they_are(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    before = len(session._made)
    corpus_pipeline.join_near_copies(spark, docs, FOLDER)
    assert not [path for _, path in session._made[before:] if "numbered-rows" in path]
