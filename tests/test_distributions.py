"""Pairs by key, sets, diversity, fits and bootstrap intervals against brute force."""

import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularium.operators import ecology, enrichment, fits, pairs


@pytest.mark.parametrize("stripe", [1, 3, 2000])
def test_pairs_by_brute_force(spark, monkeypatch, stripe):
    monkeypatch.setattr(pairs, "STRIPE", stripe)
    rows = [("hot", i, i * i) for i in range(60)] + [("b", 3, 1), ("b", 1, None), ("c", 9, 9), (None, 4, 4), (None, 5, 5), ("b", None, 7)]
    got = pairs.pairs_by_key(spark.createDataFrame(rows, "k string, n long, v long"), "k", "n", ["v"]).select("k", "a", "b", "a_v", "b_v").collect()
    want = [(k, n, m, v, w) for (k, n, v), (j, m, w) in itertools.product(rows, rows) if k is not None and k == j and n is not None and m is not None and n < m]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def set_rows():
    rng = random.Random(4)
    rows = [(f"s{i}", m) for i in range(12) for m in rng.sample(range(80), rng.randrange(1, 40))] + [("whole", m) for m in range(80)]
    return rows + rows[:30] + [(None, 3), ("s1", None), ("lone", 999)]


def test_enrichment_by_counting(spark):
    rows = set_rows()
    chosen = [(m,) for m in range(0, 80, 3)] + [(None,), (3,), (5000,)]
    df, picked = spark.createDataFrame(rows, "s string, m long"), spark.createDataFrame(chosen, "m long")
    for everything in (None, [(m,) for m in range(60)] + [(7777,), (None,), (5,)]):
        universe = {m for _, m in rows if m is not None} if everything is None else {m for m, in everything if m is not None}
        got = {r.set: r for r in enrichment.over_representation(df, "s", "m", picked, None if everything is None else spark.createDataFrame(everything, "m long")).collect()}
        sets = defaultdict(set)
        for s, m in rows:
            if s is not None and m in universe:
                sets[s].add(m)
        drawn = {m for m, in chosen} & universe
        ps = {}
        for s, members in sets.items():
            k, size, n, total = len(members & drawn), len(members), len(drawn), len(universe)
            ps[s] = sum(math.comb(size, i) * math.comb(total - size, n - i) for i in range(k, min(size, n) + 1)) / math.comb(total, n)
            assert (got[s].size, got[s].hits) == (size, k) and got[s].expected == pytest.approx(size * n / total) and got[s].p == pytest.approx(ps[s])
        assert set(got) == set(sets)
        for s in sets:
            assert got[s].p_bh == pytest.approx(min(1, min(q * len(ps) / sum(x <= q for x in ps.values()) for q in ps.values() if q >= ps[s] - 1e-15)), rel=1e-6)
    assert enrichment.over_representation(df.limit(0), "s", "m", picked).collect() == []
    assert all(r.hits == 0 and r.p == 1 for r in enrichment.over_representation(df, "s", "m", picked.limit(0)).collect())


@pytest.mark.parametrize("least", [1, 5])
def test_overlaps_by_brute_force(spark, least):
    rows = set_rows()
    sets = defaultdict(set)
    for s, m in rows:
        if s is not None and m is not None:
            sets[s].add(m)
    got = {(r.a, r.b): (r.shared, r.jaccard) for r in enrichment.set_overlaps(spark.createDataFrame(rows, "s string, m long"), "s", "m", least).collect()}
    want = {(a, b): (len(sets[a] & sets[b]), pytest.approx(len(sets[a] & sets[b]) / len(sets[a] | sets[b]))) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= least}
    assert got == want


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(8)
    rows = [(f"s{i}", f"t{int(rng.paretovariate(0.7)) % 25}", rng.choice([1, 1, 2, 9])) for i in range(9) for _ in range(rng.randrange(1, 60))]
    rows += [("hot", "t1", 1)] * 50 + [("one", "only", 5), (None, "t1", 3), ("s1", None, 3), ("gone", "t1", 0), ("less", "t2", -4)]
    counts = defaultdict(Counter)
    for s, t, n in rows:
        if s is not None and t is not None:
            counts[s][t] += n
    counts = {s: {t: n for t, n in c.items() if n > 0} for s, c in counts.items()}
    frame = ecology.abundances(spark.createDataFrame(rows, "s string, t string, n long"), "s", "t", "n")
    return frame, {s: c for s, c in counts.items() if c}


def test_diversity_by_definition(samples):
    frame, counts = samples
    got = {r["sample"]: r for r in ecology.diversity(frame).collect()}
    assert set(got) == set(counts)
    for s, c in counts.items():
        total, p = sum(c.values()), [n / sum(c.values()) for n in c.values()]
        r, h, same = got[s], -sum(x * math.log(x) for x in p), sum(x * x for x in p)
        once, twice = sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())
        assert (r.richness, r.total) == (len(c), total) and r.shannon == pytest.approx(h, abs=1e-9)
        assert (r.simpson, r.inverse_simpson, r.chao1) == pytest.approx((1 - same, 1 / same, len(c) + once * (once - 1) / (2 * (twice + 1))))
        assert r.evenness == pytest.approx(h / math.log(len(c))) if len(c) > 1 else r.evenness is None


def test_distances_and_ratios_by_definition(samples):
    frame, counts = samples
    got = {(r.a, r.b): r.distance for r in ecology.bray_curtis(frame).collect()}
    want = {}
    for a, b in itertools.combinations(sorted(counts), 2):
        if shared := sum(min(n, counts[b].get(t, 0)) for t, n in counts[a].items()):
            want[a, b] = pytest.approx(1 - 2 * shared / (sum(counts[a].values()) + sum(counts[b].values())))
    assert got == want
    taxa = {t for c in counts.values() for t in c}
    rows = ecology.centred_log_ratio(frame, 0.5).collect()
    assert len(rows) == sum(map(len, counts.values()))
    for r in rows:
        logs = [math.log(counts[r["sample"]].get(t, 0) + 0.5) for t in taxa]
        assert (r.clr, r.clr_absent) == pytest.approx((math.log(r.n + 0.5) - np.mean(logs), math.log(0.5) - np.mean(logs)))
    for r in ecology.rarefied_richness(frame, 7).collect():
        c = counts[r["sample"]]
        total = sum(c.values())
        assert r.total == total
        assert r.expected == pytest.approx(sum(1 - math.comb(total - n, 7) / math.comb(total, 7) for n in c.values())) if total >= 7 else r.expected is None


def test_diversity_of_nothing(samples):
    empty = samples[0].limit(0)
    for frame in (ecology.diversity(empty), ecology.bray_curtis(empty), ecology.centred_log_ratio(empty), ecology.rarefied_richness(empty, 3)):
        assert frame.collect() == []


@pytest.mark.parametrize("cuts", [4, 500])
def test_power_law_by_definition(spark, cuts):
    rng = np.random.default_rng(6)
    values = [float(v) for v in np.floor(3 * (1 - rng.random(2000)) ** (-1 / 1.5))] + [1.0] * 300
    rows = [(v,) for v in values] + [(None,), (0.0,), (-3.0,), (float("nan"),), (float("inf"),)]
    got = fits.power_law(spark.createDataFrame(rows, "v double"), "v", cuts).collect()
    different = sorted(set(values))
    tried = different if len(different) <= cuts else sorted({min(v for v in different if v >= g * (1 - 1e-15)) for g in (different[0] * (different[-1] / different[0]) ** (i / cuts) for i in range(cuts))})
    assert [r.cut for r in sorted(got)] == [c for c in tried if c < different[-1]]
    for r in got:
        tail = np.array([v for v in values if v >= r.cut])
        alpha = 1 + len(tail) / np.log(tail / (r.cut - 0.5)).sum()
        ks = max(abs((tail <= x).mean() - (1 - ((x + 0.5) / (r.cut - 0.5)) ** (1 - alpha))) for x in set(tail))
        assert r.n_tail == len(tail) and (r.alpha, r.ks) == pytest.approx((alpha, ks))
    assert [r.cut for r in got if r.best] == [min(got, key=lambda r: (r.ks, r.cut)).cut]
    for odd in ([], [(None,)], [(4.0,)] * 3):
        assert fits.power_law(spark.createDataFrame(odd, "v double"), "v").collect() == []


def test_tails_and_zipf_by_definition(spark):
    rng = np.random.default_rng(7)
    x = np.exp(rng.normal(2, 1, 500)).round(3)
    got = {r.model: r for r in fits.compare_tails(spark.createDataFrame([(float(v),) for v in x] + [(None,), (-1.0,)], "v double"), "v").collect()}
    alpha = 1 + len(x) / np.log(x / x.min()).sum()
    mean, sd, rate = np.log(x).mean(), np.log(x).std(), 1 / x.mean()
    want = {"power law": (alpha, x.min(), np.log((alpha - 1) / x.min() * (x / x.min()) ** -alpha).sum(), 2),
            "log-normal": (mean, sd, (-np.log(x * sd * math.sqrt(2 * math.pi)) - (np.log(x) - mean) ** 2 / (2 * sd * sd)).sum(), 2),
            "exponential": (rate, None, (np.log(rate) - rate * x).sum(), 1)}
    for model, (a, b, ll, k) in want.items():
        r = got[model]
        assert (r["first"], r.log_likelihood, r.aic) == pytest.approx((a, ll, 2 * k - 2 * ll)) and r.second == (pytest.approx(b) if b is not None else None)
    assert got["log-normal"].aic == min(r.aic for r in got.values())
    assert fits.compare_tails(spark.createDataFrame([], "v double"), "v").collect() == []
    words = ["the"] * 300 + [f"w{i}" for i in range(40) for _ in range(40 - i)] + [None] * 9
    row = fits.zipf(spark.createDataFrame([(w,) for w in words], "w string"), "w").first()
    counts = sorted(Counter(w for w in words if w).values(), reverse=True)
    slope, start = np.polyfit(np.log(np.arange(1, len(counts) + 1)), np.log(counts), 1)
    assert (row.n_values, row.total) == (len(counts), sum(counts)) and (row.slope, row.intercept) == pytest.approx((slope, start))


def test_bootstrap_by_definition(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([1.0, 5.0, 9.0, None, float("nan")])) for i in range(200)] + [(5, "a", 3.0), (None, "a", 7.0)]
    rows += [(1000 + i, "hot", float(i)) for i in range(600)] + [(-1, "none", None)]
    df = spark.createDataFrame(rows, "k long, g string, v double")
    got = {r.g: r for r in fits.bootstrap_mean(df.repartition(7), "v", "k", ["g"], 60, 0.9).collect()}

    def weight(key, r):
        if key is None:
            return 0
        h = hashlib.md5(str(key).encode()).hexdigest()
        u = (int(h[:8], 16) + r * int(h[8:16], 16)) % 2 ** 32 / 2 ** 32
        return sum(u >= s for s in fits.POISSON_SHARES)

    for g in ("a", "b", None, "hot"):
        own = [(k, v) for k, gg, v in rows if gg == g and v is not None and not math.isnan(v)]
        means = [sum(weight(k, r) * v for k, v in own) / sum(weight(k, r) for k, _ in own) for r in range(1, 61)]
        keyed = [(k, v) for k, v in own]
        assert got[g].n == len(keyed) and got[g].mean == pytest.approx(np.mean([v for _, v in keyed]))
        assert (got[g].low, got[g].high) == pytest.approx(tuple(np.quantile(means, [0.05, 0.95])))
    assert "none" not in got and got["hot"].low < got["hot"].mean < got["hot"].high
    spread = got["hot"].high - got["hot"].low
    assert spread == pytest.approx(2 * 1.645 * np.std(range(600)) / math.sqrt(600), rel=0.35)


def test_growth_by_definition(spark):
    rows = [(2000 + i, 100 * 1.3 ** i) for i in range(8)] + [(2001, 0.0), (2002, None), (None, 5.0)]
    got = {(r.kind, r.time): r.value for r in fits.exponential_growth(spark.createDataFrame(rows, "t int, n double"), "t", "n", [2010]).collect()}
    assert got["rate", None] == pytest.approx(math.log(1.3)) and got["doubling", None] == pytest.approx(math.log(2) / math.log(1.3)) and got["forecast", 2010.0] == pytest.approx(100 * 1.3 ** 10)
    assert fits.exponential_growth(spark.createDataFrame([(1, 2.0)], "t int, n double"), "t", "n").collect() == []
