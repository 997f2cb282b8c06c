"""Motifs, sequences, profiles, combined evidence and survival against brute force."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularium.operators import evidence, motifs, profiles, sequences, survival

# ---- motifs ----------------------------------------------------------------


def random_matrix(rng, length):
    return [[float(rng.choice([0, 0, 1, 5, 20])) for _ in range(4)] for _ in range(length)]


def shares_of(m):
    return np.array([[x / sum(p) if sum(p) else 0.25 for x in p] for p in m])


def best_alignment(a, b, least):
    x, found = shares_of(a), []
    for strand, y in (("+", shares_of(b)), ("-", shares_of(b)[::-1, ::-1])):
        for offset in range(-len(y) + 1, len(x)):
            at = range(max(0, offset), min(len(x), offset + len(y)))
            if len(at) >= min(least, len(x), len(y)):
                each = []
                for i in at:
                    u, v = x[i] - 0.25, y[i - offset] - 0.25
                    each.append((u * v).sum() / math.sqrt((u * u).sum() * (v * v).sum()) if (u * u).sum() * (v * v).sum() else 0.0)
                found.append((-round(float(np.mean(each)), 9), -len(at), strand, offset))
    score, _, strand, offset = min(found)
    return -score, offset, strand


def test_motifs_by_definition(spark):
    rng = random.Random(5)
    rows = [(i, random_matrix(rng, rng.randrange(1, 8))) for i in range(12)] + [(50, [[0.0] * 4, [3.0, 1.0, 0.0, 0.0]])]
    planted = random_matrix(rng, 6)
    rows += [(51, planted), (52, [p[::-1] for p in planted[::-1]][1:]), (53, [[1.0, 2.0, 3.0, 4.0]] * 2 + planted)]
    lists = [(i, *[[p[k] for p in m] for k in range(4)]) for i, m in rows] + [(90, [1.0], [1.0, 2.0], [1.0], [1.0]), (91, None, [1.0], [1.0], [1.0]), (92, [], [], [], [])]
    df = spark.createDataFrame(lists, "id long, A array<double>, C array<double>, G array<double>, T array<double>").select("id", motifs.positions(*map(F.col, "ACGT")).alias("m"))
    background = (0.3, 0.2, 0.2, 0.3)
    got = {r.id: r for r in df.select("id", "m", motifs.log_odds(F.col("m"), 0.8, background).alias("w"), motifs.information(F.col("m")).alias("bits")).collect()}
    for i, m in rows:
        assert got[i].m == m
        for p, w, bits in zip(m, got[i].w, got[i].bits, strict=True):
            assert w == pytest.approx([math.log2((n + 0.8 * b) / (sum(p) + 0.8) / b) for n, b in zip(p, background, strict=True)])
            assert bits == (pytest.approx(2 + sum(n / sum(p) * math.log2(n / sum(p)) for n in p if n)) if sum(p) else None)
    assert got[90].m is None and got[91].m is None and got[92].bits == []
    both = df.select(F.col("id").alias("a"), F.col("m").alias("x")).join(df.select(F.col("id").alias("b"), F.col("m").alias("y")), F.expr("a < b"))
    found = {(r.a, r.b): r.s for r in both.select("a", "b", motifs.similarity(F.col("x"), F.col("y")).alias("s")).collect()}
    for (i, x), (j, y) in itertools.combinations(rows, 2):
        score, offset, strand = best_alignment(x, y, 3)
        assert found[i, j].score == pytest.approx(score, abs=1e-8) and (found[i, j].offset, found[i, j].strand) == (offset, strand)
    assert found[0, 90] is None and found[0, 91] is None and found[0, 92] is None
    assert found[51, 53].score == pytest.approx(1) and found[51, 52].strand == "-"


# ---- sequences -------------------------------------------------------------


def test_composition(spark):
    rows = [("hot", "AaßMK-L"), ("hot", "ACDE" * 500), (None, "mmm"), ("empty", ""), ("null", None)]
    got = {(r.g, r.residue): (r.n, r.share, r.enrichment) for r in sequences.composition(spark.createDataFrame(rows, "g string, s string"), "s", ["g"], {"A": 0.1, "M": 0.5}).collect()}
    counts = Counter((g, c.upper()) for g, s in rows for c in s or "" if c.isascii() and c.isalpha())
    assert {k: v[0] for k, v in got.items()} == counts
    total = sum(n for (g, _), n in counts.items() if g == "hot")
    assert got["hot", "A"][1:] == pytest.approx((counts["hot", "A"] / total, math.log2(counts["hot", "A"] / total / 0.1))) and got["hot", "K"][2] is None
    assert got[None, "M"][1:] == (1.0, 1.0)


@pytest.mark.parametrize("share", [0.5, 0.9])
def test_contiguity_by_definition(spark, share):
    rng = random.Random(1)
    pieces = {"a": [rng.randrange(1, 50) for _ in range(200)], "hot": [7] * 400 + [1], "one": [9], None: [5, 5, 10], "half": [10, 5, 5]}
    rows = [(g, n) for g, v in pieces.items() for n in v] + [("a", None), ("a", 0), ("a", -4), ("bad", None)]
    rng.shuffle(rows)
    got = {r.g: r for r in sequences.contiguity(spark.createDataFrame(rows, "g string, n int"), "n", ["g"], share).collect()}
    assert set(got) == set(pieces)
    for g, v in pieces.items():
        upto, order = 0, sorted(v, reverse=True)
        for k, n in enumerate(order, 1):
            upto += n
            if upto >= sum(v) * share:
                break
        r = got[g]
        assert (r.n_pieces, r.total, r.longest, r.n_length, r.n_pieces_to) == (len(v), sum(v), max(v), n, k)
    assert sequences.contiguity(spark.createDataFrame([], "g string, n int"), "n", ["g"]).collect() == []


def test_gene_density_by_positions(spark):
    rng = random.Random(2)
    rows = [("x", s, s + rng.choice([0, 3, 40, 250])) for s in (rng.randrange(1, 900) for _ in range(80))] + [("y", 1, 1), ("y", 100, 101), ("y", 1, 1), ("hot", 5, 60)] + [("hot", 7, 7)] * 300
    df = spark.createDataFrame(rows + [("x", None, 5), ("x", 9, 3), (None, 1, 2), ("x", 0, 4)], "r string, s long, e long")
    got = {(r.region, r.bin): (r.bin_start, r.n_genes, r.covered, r.share) for r in sequences.gene_density(df, "r", "s", "e", 100).collect()}
    want = {}
    for region in {r for r, _, _ in rows}:
        for b in range(13):
            inside = set(range(b * 100 + 1, b * 100 + 101))
            touching = [inside & set(range(s, e + 1)) for r, s, e in rows if r == region]
            if n := sum(map(bool, touching)):
                covered = len(set().union(*touching))
                want[region, b] = (b * 100 + 1, n, covered, covered / 100)
    assert got == want


# ---- profiles --------------------------------------------------------------


def test_term_weights_by_definition(spark):
    rng = random.Random(3)
    rows = [(f"d{i}", f"t{int(rng.paretovariate(0.8)) % 30}") for i in range(10) for _ in range(40)] + [(f"d{i}", "everywhere") for i in range(10)] * 3 + [("d3", None), (None, "t1"), ("plain", "everywhere")]
    counts = Counter((d, t) for d, t in rows if d and t)
    n, df = len({d for d, _ in counts}), Counter(t for _, t in counts)
    weight = {(d, t): c * math.log(n / df[t]) for (d, t), c in counts.items()}
    length = {d: math.sqrt(sum(w * w for (e, _), w in weight.items() if e == d)) for d, _ in counts}
    weights = profiles.tf_idf(spark.createDataFrame(rows, "d string, t string"), "d", "t")
    got = {(r.document, r.term): (r.tf, r.df, r.weight) for r in weights.collect()}
    assert got == {(d, t): (c, df[t], pytest.approx(weight[d, t] / length[d] if length[d] else 0)) for (d, t), c in counts.items()}
    top = profiles.top_terms(weights.withColumn("weight", F.round("weight", 9)), 3).collect()
    for d in length:
        want = sorted((-round(w[2], 9), t) for (e, t), w in got.items() if e == d)[:3]
        assert [(-r.weight, r.term) for r in sorted((r for r in top if r.document == d), key=lambda r: r.rank)] == want


@pytest.mark.parametrize("scale", [False, True])
def test_components_by_decomposition(spark, scale):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + 1e6
    x[:, 3] = 7.0
    rows = [tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0, 1.0), (float("nan"), 1.0, 1.0, 1.0), (1.0, float("inf"), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    table, scores = profiles.principal_components(df, list("abcd"), 2, scale)
    c = np.cov(x.T)
    sd = np.sqrt(np.diag(c))
    by = np.where(sd > 1e-9, sd, 1) if scale else np.ones(4)
    c = c / np.outer(by, by)
    values, axes = np.linalg.eigh(c)
    for k in (1, 2):
        own = table.where(F.col("component") == k).collect()
        assert own[0].variance == pytest.approx(values[-k], rel=1e-6) and own[0].share == pytest.approx(values[-k] / np.trace(c), rel=1e-6)
        loadings = np.array([{r.column: r.loading for r in own}[n] for n in "abcd"])
        assert abs(loadings @ axes[:, -k]) == pytest.approx(1, abs=1e-6) and loadings[np.abs(loadings).argmax()] > 0
    got = df.select(scores.alias("s")).collect()
    assert np.array([r.s for r in got[:300]]).var(axis=0, ddof=1) == pytest.approx(values[::-1][:2], rel=1e-5) and got[300].s is None
    nothing, _ = profiles.principal_components(df.limit(0), list("abcd"), 2)
    assert nothing.collect() == []


def test_clusters_by_plain_rounds(spark):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(c, 0.5, (40, 2)) for c in ((0, 0), (5, 5), (0, 6))] + [[[1.0, 1.0]]] * 50).round(3)
    rows = [(int(k), float(a), float(b)) for k, (a, b) in zip(rng.permutation(len(x)), x, strict=True)]
    odd = [(None, 1.0, 1.0), (900, None, 1.0), (901, float("nan"), 1.0), (902, 1.0, float("inf"))]
    df = spark.createDataFrame(rows + odd + rows[:1], "k long, a double, b double")
    found, centres = profiles.k_means(df, "k", ["a", "b"], 3)
    points = sorted(rows + rows[:1])
    start = []
    for _, a, b in points:
        if (a, b) not in start and len(start) < 3:
            start.append((a, b))
    means = np.array(start)
    values = np.array([p[1:] for p in points])
    for _ in range(50):
        at = ((values[:, None] - means[None]) ** 2).sum(axis=2).argmin(axis=1)
        means = np.array([values[at == i].mean(axis=0) if (at == i).any() else means[i] for i in range(3)])
    assert np.allclose(centres, means)
    assert sorted((r.k, r.cluster) for r in found.collect()) == sorted((p[0], int(i)) for p, i in zip(points, at, strict=True))
    for few in (df.limit(0), spark.createDataFrame(odd, df.schema)):
        assert profiles.k_means(few, "k", ["a", "b"], 3)[0].collect() == []


# ---- evidence --------------------------------------------------------------


def test_evidence_by_products(spark):
    groups = {"a": [0.2, 0.5, 0.0], "sure": [0.3, 1.0], "tiny": [1e-12] * 400, None: [0.9], "zero": [0.0], "hot": [0.001] * 900}
    rows = [(g, p) for g, ps in groups.items() for p in ps] + [("a", None), ("a", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, p double")
    for prior in (0.0, 0.041):
        got = {r.g: r for r in evidence.combine_rows(df, ["g"], "p", prior).collect()}
        for g, ps in groups.items():
            assert got[g].n == len(ps) and got[g].combined == pytest.approx(max(0, (-math.expm1(sum(math.log1p(-p) if p < 1 else -math.inf for p in ps)) - prior) / (1 - prior)), rel=1e-9)
        assert (got["none"].n, got["none"].combined, got["sure"].combined) == (0, 0.0, 1.0)
    with pytest.raises(Exception, match="outside"):
        evidence.combine_rows(spark.createDataFrame([("a", 1.5)], df.schema), ["g"], "p").collect()
    wide = spark.createDataFrame([(0.5, 0.5), (None, 0.3), (None, None), (1.0, 0.0)], "x double, y double")
    got = [r[0] for r in wide.select(evidence.combine_channels([F.col("x"), F.col("y")], 0.1)).collect()]
    assert got == pytest.approx([(0.75 - 0.1) / 0.9, 0.2 / 0.9, 0.0, 1.0])


def test_rank_scores(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", 2.0), ("a", None), ("flat", 5.0), ("flat", 5.0), (None, 0.0), (None, 10.0)]
    got = evidence.rank_score(spark.createDataFrame(rows, "g string, r double").withColumn("score", F.lit("old")), "r", ["g"]).collect()
    assert sorted((str(r.g), str(r.r), r.score) for r in got) == sorted([("a", "1.0", 100.0), ("a", "3.0", 0.0), ("a", "2.0", 50.0), ("a", "None", None), ("flat", "5.0", None), ("flat", "5.0", None), ("None", "0.0", 100.0), ("None", "10.0", 0.0)], key=str)


# ---- survival --------------------------------------------------------------


def test_curves_by_definition(spark):
    rng = random.Random(6)
    rows = [(g, float(rng.randrange(1, 12)), rng.random() < 0.5) for g in ("a", "b", None) for _ in range(70)]
    rows += [("end", 1.0, True), ("end", 2.0, True), ("hot", 3.0, True)] + [("hot", 3.0, False)] * 400 + [("a", None, True), ("a", float("nan"), True), ("b", 4.0, None), ("never", 5.0, False)]
    got = {(r.g, r.t): r for r in survival.kaplan_meier(spark.createDataFrame(rows, "g string, x double, e boolean"), "x", F.col("e"), ["g"]).withColumnRenamed("time", "t").collect()}
    want = set()
    for g in {r[0] for r in rows}:
        own = [(t, e) for gg, t, e in rows if gg == g and t is not None and not math.isnan(t)]
        s, v = 1.0, 0.0
        for t in sorted({t for t, e in own if e}):
            n, d = sum(u >= t for u, _ in own), sum(u == t and bool(e) for u, e in own)
            s *= 1 - d / n
            v += d / (n * (n - d)) if d < n else 0
            r = got[g, t]
            assert (r.at_risk, r.events) == (n, d) and (r.survival, r.std_error) == pytest.approx((s, s * math.sqrt(v)), abs=1e-12)
            want.add((g, t))
    assert set(got) == want and got["end", 2.0].survival == 0.0
    assert survival.kaplan_meier(spark.createDataFrame([], "g string, x double, e boolean"), "x", F.col("e")).collect() == []


def test_log_rank_by_definition(spark):
    rng = random.Random(7)
    rows = [(g, float(rng.randrange(1, 20 if g == "a" else 9)), rng.random() < 0.7) for g in "ab" for _ in range(60)] + [("c", 1.0, True), ("a", None, True)]
    got = survival.log_rank(spark.createDataFrame(rows, "g string, x double, e boolean"), "x", F.col("e"), "g", "a", "b").first()
    own = [r for r in rows if r[0] in "ab" and r[1] is not None]
    o = e = v = 0.0
    for t in {x for _, x, ev in own if ev}:
        n, n1 = sum(x >= t for _, x, _ in own), sum(x >= t and g == "a" for g, x, _ in own)
        d, d1 = sum(x == t and ev for _, x, ev in own), sum(x == t and ev and g == "a" for g, x, ev in own)
        o, e = o + d1, e + d * n1 / n
        v += d * n1 / n * (1 - n1 / n) * (n - d) / (n - 1) if n > 1 else 0
    assert (got.observed, got.expected, got.variance, got.chi2) == pytest.approx((o, e, v, (o - e) ** 2 / v))
    assert got.p == pytest.approx(math.erfc(math.sqrt(got.chi2 / 2)), abs=1e-9)
    assert survival.log_rank(spark.createDataFrame([], "g string, x double, e boolean"), "x", F.col("e"), "g", "a", "b").first().p is None
