"""Quality votes, ranked search and vector codes against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabularium.llm import quality, queries, ranked_search, vector_codes

FOLDER = "/root/testdata/sf0.01"


# Quality votes

def test_quality_of_held_out_documents(spark):
    rows = {r.doc_id: r for r in queries.quality_votes(spark, FOLDER).collect()}
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert len(rows) == documents.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    held = [(rows[r.doc_id], r.quality) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality IS NOT NULL").collect() if rows[r.doc_id].held_out]
    assert len(held) > 50 and sum(r.predicted == q for r, q in held) >= 0.97 * len(held)
    good, bad = [r.score for r, q in held if q == 1], [r.score for r, q in held if q == 0]
    assert sum(a > b for a in good for b in bad) >= 0.98 * len(good) * len(bad)


def test_labels_of_held_out_documents_change_nothing(spark):
    documents, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 4 = 2, 1 - quality, quality) AS quality", "1 - toxic AS toxic")
    a, b = quality.learn(documents, labels), quality.learn(documents.withColumn("lang", documents["source"]), turned)
    assert (a.vectors == b.vectors).all() and (a.labels == b.labels).all()


def test_votes_by_plain_loops():
    rng = np.random.default_rng(4)
    unit = lambda n: quality._unit(rng.normal(size=(n, 6)))
    model = quality.QualityModel(np.ones(quality.BUCKETS), np.zeros((quality.BUCKETS, 6)), np.repeat(unit(60), 2, axis=0), rng.integers(0, 2, 120).astype(float))
    asked = np.vstack([unit(700), np.zeros((1, 6))])
    for v, got in zip(asked, model.vote(asked), strict=True):
        cosine = [round(float(v @ w), 9) for w in model.vectors]
        last = sorted(cosine)[-quality.NEIGHBOURS]
        weight = [max(c, 0) ** quality.POWER if c >= last else 0 for c in cosine]
        want = sum(w * y for w, y in zip(weight, model.labels, strict=True)) / sum(weight) if sum(weight) else model.labels.mean()
        assert got == pytest.approx(want, abs=1e-6)


def test_quality_of_odd_rows(spark):
    good, bad = [f"the quiet river number {i} runs past old houses" for i in range(30)], [f"BUY!! NOW!! {i}$$$ BUY!! NOW!!" for i in range(30)]
    texts = [t for pair in zip(good, bad, strict=True) for t in pair]
    documents = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a", "x"), (900, None, "x")], "doc_id long, text string, Score string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)] + [(3, 0), (3, None), (None, 1), (900, 1), (5, 7)], "doc_id long, quality int")
    model = quality.learn(documents, labels)
    asked = spark.createDataFrame([(1, "the old river runs past quiet houses", 1, "p"), (2, "BUY!! NOW!! CHEAP$$$", 2, "p"), (3, "", 3, "p"), (4, None, 4, "p"),
                                   (5, "BUY!! NOW!! " * 150_000, 5, "p"), (1, "the old river runs past quiet houses", 1, "p")], "doc_id long, text string, SCORE int, `a.b` string")
    out = quality.score_quality(asked, "text", model)
    assert out.columns == ["doc_id", "text", "a.b", "score", "predicted"]
    rows = sorted((r.doc_id, r.score, r.predicted) for r in out.collect())
    assert rows[0] == rows[1] and rows[0][2] == 1 and rows[2][2] == rows[5][2] == 0 and rows[3][1] == rows[4][1] == pytest.approx(model.prior)
    assert quality.score_quality(asked.limit(0), "text", model).collect() == []
    nothing = quality.learn(documents, labels.limit(0))
    assert {(r.score, r.predicted) for r in quality.score_quality(asked, "text", nothing).collect()} == {(0.5, 0)}
    assert quality.learn(documents.limit(0), labels).prior == 0.5


# Ranked search

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def ranked_by_brute_force(items, documents, best=10):
    bags = [(k, Counter(words_of(t))) for k, t in documents]
    with_terms = [b for _, b in bags if b]
    n_all, length = len(with_terms), sum(sum(b.values()) for b in with_terms)
    df = Counter(t for b in with_terms for t in b)
    asked = defaultdict(list)
    for k, t in items:
        asked[k] += words_of(t)
    out = []
    for k, terms in asked.items():
        scores = []
        for key, bag in bags:
            m = 100 - 75 + (75 * sum(bag.values()) * n_all) // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in terms if t in bag)
            scores.append((-score, key is None, key))
        out += [(k, i + 1, key, -s) for i, (s, _, key) in enumerate([s for s in sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0)) if s[0] < 0][:best])]
    return sorted(out, key=str)


def test_search_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "POSTINGS", 300)
    monkeypatch.setattr(ranked_search, "ITEM_TERMS", 40)
    rng = random.Random(6)
    word = lambda: rng.choice(["the", "of", "Straße", "ÉTÉ", "été", "x1"] + [f"w{int(rng.paretovariate(0.5)) % 300}" for _ in range(6)])
    documents = [(i * 13 % 991, rng.choice([" ", ", ", "\n", "_"]).join(word() for _ in range(rng.choice([0, 1, 5, 20, 60, 400])))) for i in range(400)]
    documents += [(5000 + i, "hot the of") for i in range(200)] + [(7, "The THE the"), (7, "the the the"), (None, "hot the of"), (None, None), (9001, ""), (9002, "?! \u007f"), (9003, "İ K ß")]
    documents += [(9004, "w1 " * 400_000)]
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 10, 40])))) for i in range(40)] + [(1, "hot"), (100, None), (101, ""), (102, "nowhere"), (None, "the of"), (103, "hot the of hot"), (104, "İ ß k")]
    left = spark.createDataFrame([(k, t, 1, 2) for k, t in items], "item_id long, text string, rank int, term int")
    right = spark.createDataFrame([(k, t, 1, "q") for k, t in documents], "doc_id long, text string, score int, item_id string")
    rows = ranked_search.search(left, "item_id", "text", right, "doc_id", "text")
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, rows.collect()), key=str) == ranked_by_brute_force(items, documents)
    for a, b in ((left.limit(0), right), (left, right.limit(0)), (left.where("item_id = 100"), right)):
        assert ranked_search.search(a, "item_id", "text", b, "doc_id", "text").collect() == []


def test_intervals_end_with_the_right_documents(monkeypatch):
    monkeypatch.setattr(ranked_search, "DEPTH", 1)
    rng = np.random.default_rng(8)
    for _ in range(300):
        size, best = int(rng.integers(1, 60)), int(rng.integers(1, 12))
        full = rng.integers(1, rng.choice([3, 1000]), (int(rng.integers(1, 6)), size)) * (rng.random((1, size)) < rng.random())
        floors = [np.where(row > 0, rng.integers(0, 2) * row, 0) for row in full]
        lists = [(d := np.argsort(-row, kind="stable")[:int((row > 0).sum())], row[d]) for row in full]
        tie = rng.permutation(size)
        total = full.sum(axis=0)
        want = [d for d in sorted(range(size), key=lambda d: (-total[d], tie[d])) if total[d] > 0][:best]
        got, scores = ranked_search.search_lists(lists, floors, size, best, tie)
        assert got.tolist() == want and scores.tolist() == total[want].tolist()


def test_terms_of_a_text_in_slices(monkeypatch):
    text = "Ab1 é ß-x " * 50 + "y" * 300 + " z"
    want = Counter(w.encode() for w in words_of(text))
    for size in (1, 2, 7, 64, 5000):
        monkeypatch.setattr(ranked_search, "SLICE", size)
        assert ranked_search.count_terms(text.encode()) == want


# Vector codes

def codes_by_brute_force(rows, parts=8, entries=16, rounds=6):
    kept = [(k, v, y) for k, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    cut = [[[math.floor(4096 * x) for x in v[p * len(v) // parts:(p + 1) * len(v) // parts]] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, sum(cut[i], [])))
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    place = lambda: [[min((far(c[p], e), j) for j, e in enumerate(books[p])) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        found = place()
        for p in range(parts):
            for j in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found, strict=True) if f[p][1] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = place()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, y), e in zip(kept, errors, strict=True):
        by_label[y] += e
    seal = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((k, "".join(f"{j:02x}" for _, j in f), e, by_label[y], seal) for (k, _, y), f, e in zip(kept, found, errors, strict=True)), key=str)


def odd_vectors(n, dims):
    rng = random.Random(n)
    vectors = [[round(rng.gauss(0, 1) * rng.choice([0.01, 1]), 3) for _ in range(dims)] for _ in range(n)]
    vectors += [[0.0] * dims, [0.25] * dims, [-0.0] * dims] + [vectors[0]] * (n // 2) if n else []
    bad = [None, [float("nan")] + [1.0] * (dims - 1), [float("inf")] * dims, [None] * dims] if dims else [None]
    rows = [(i * 7 % 401 if i % 9 else None, v, rng.choice([None, 1, 1, 1, 2])) for i, v in enumerate(vectors)] + [(-1, v, 3) for v in bad]
    return rows + rows[:3]


@pytest.mark.parametrize("n,dims", [(150, 16), (5, 8), (40, 64), (3, 0), (0, 8)])
def test_codes_by_brute_force(spark, n, dims):
    rows = odd_vectors(n, dims)
    df = spark.createDataFrame([(k, v, y, 1, "c") for k, v, y in rows], "vec_id long, vector array<double>, label int, error int, code string")
    got = vector_codes.code_report(df, "vec_id", "vector", "label").collect()
    assert sorted(map(tuple, got), key=str) == codes_by_brute_force(rows)


def test_codes_of_unfit_tables(spark):
    frame = lambda rows: spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id long, vector array<double>, label int")
    for rows in ([[1.0] * 8, [1.0] * 16], [[1.0] * 9], [[1e300] * 8]):
        with pytest.raises(ValueError):
            vector_codes.compress(frame(rows), "vec_id", "vector", "label")
    assert vector_codes.code_report(frame([]), "vec_id", "vector", "label").collect() == []


def test_nearest_entry_is_that_of_a_full_search():
    rng = np.random.default_rng(3)
    for _ in range(200):
        width, entries = int(rng.integers(1, 9)), int(rng.integers(1, 17))
        x, book = rng.integers(-4, 5, (50, width)), rng.integers(-4, 5, (entries, width))
        full = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        at, far = vector_codes.nearest(x, book)
        assert (at == full.argmin(axis=1)).all() and (far == full.min(axis=1)).all()
