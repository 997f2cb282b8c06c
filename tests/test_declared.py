"""Networks, corrections of many tests, rank correlation and group tests against brute force."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularium.functions import special
from tabularium.operators import group_tests, multiple, network, ranks

# ---- networks --------------------------------------------------------------


def network_rows(seed):
    """Random edges with loops, repeats, reversed ones and nulls, a chain, and a hub with most of the edges."""
    rng = random.Random(seed)
    rows = [(rng.randrange(40), rng.randrange(40)) for _ in range(90)] + [(100 + i, 101 + i) for i in range(30)]
    rows += [(500, i) for i in range(501, 700)] + [(501 + i, 502 + i) for i in range(0, 60, 3)]
    rows += [(3, 3), (None, 4), (5, None), (None, None)] + [(b, a) for a, b in rows[:20]]
    rng.shuffle(rows)
    return rows


def neighbours(rows):
    out = defaultdict(set)
    for a, b in rows:
        if a is not None and b is not None and a != b:
            out[a].add(b)
            out[b].add(a)
    return out


@pytest.fixture(scope="module", params=[1, 2])
def graph(spark, request):
    rows = network_rows(request.param)
    return network.undirected(spark.createDataFrame(rows, "x long, y long"), "x", "y"), neighbours(rows)


def test_degrees_and_hubs(graph):
    pairs, near = graph
    degree = {n: len(v) for n, v in near.items()}
    assert {r.node: r.degree for r in network.degrees(pairs).collect()} == degree
    counts = Counter(degree.values())
    assert {(r.degree, r.n_nodes, round(r.share_at_least, 9)) for r in network.degree_distribution(pairs).collect()} == {
        (d, n, round(sum(m for e, m in counts.items() if e >= d) / len(degree), 9)) for d, n in counts.items()}
    mean, sd = np.mean(list(degree.values())), np.std(list(degree.values()))
    assert {r.node for r in network.hubs(pairs, 2).collect()} == {n for n, d in degree.items() if (d - mean) / sd >= 2}


def test_clustering_by_brute_force(graph):
    pairs, near = graph
    closed = {n: sum(b in near[a] for a, b in itertools.combinations(sorted(v), 2)) for n, v in near.items()}
    got = {r.node: r for r in network.clustering(pairs).collect()}
    assert {n: r.n_triangles for n, r in got.items()} == closed
    for n, r in got.items():
        d = len(near[n])
        assert r.coefficient == pytest.approx(2 * closed[n] / (d * (d - 1)) if d > 1 else 0)
    row = network.summary(pairs).first()
    paths = sum(len(v) * (len(v) - 1) / 2 for v in near.values())
    assert (row.n_nodes, row.n_edges, row.n_triangles) == (len(near), sum(map(len, near.values())) // 2, sum(closed.values()) // 3)
    assert row.transitivity == pytest.approx(sum(closed.values()) / paths)


def test_paths_over_a_hub_do_not_grow_with_its_square(spark):
    star = spark.range(1, 3001).selectExpr("0 AS x", "id AS y")
    closed = network.triangles(network.undirected(star, "x", "y"))
    assert closed.collect() == []
    plan = closed._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan
    rim = spark.range(1, 3000).selectExpr("id AS x", "id + 1 AS y")
    assert network.triangles(network.undirected(star.union(rim), "x", "y")).count() == 2999


def test_components_by_search(graph):
    pairs, near = graph
    want = {}
    for n in sorted(near):
        queue = [n]
        while queue:
            x = queue.pop()
            if x not in want:
                want[x] = n
                queue += near[x]
    assert {r.node: r.component for r in network.components(pairs).collect()} == want


def propagated(near, rounds):
    names = {n: n for n in near}
    for _ in range(rounds):
        new = {}
        for n, v in near.items():
            votes = Counter([names[x] for x in v] + [names[n]])
            new[n] = min(votes, key=lambda c: (-votes[c], c))
        names = new
    return names


@pytest.mark.parametrize("rounds", [1, 4])
def test_communities_by_brute_force(graph, rounds):
    pairs, near = graph
    names = propagated(near, rounds)
    found = network.communities(pairs, rounds)
    assert {r.node: r.community for r in found.collect()} == names
    m = sum(map(len, near.values())) / 2
    table = {r.community: r for r in network.community_table(pairs, found).collect()}
    for c in set(names.values()):
        inside = sum(names[a] == c == names[b] for a in near for b in near[a]) / 2
        ends = sum(len(near[n]) for n in near if names[n] == c)
        assert (table[c].n_inside, table[c].n_ends) == (inside, ends) and table[c].modularity == pytest.approx(inside / m - (ends / (2 * m)) ** 2)


def test_networks_of_nothing(spark):
    pairs = network.undirected(spark.createDataFrame([(1, 1), (None, 2)], "x long, y long"), "x", "y")
    for frame in (network.degrees(pairs), network.degree_distribution(pairs), network.hubs(pairs), network.clustering(pairs), network.components(pairs),
                  network.communities(pairs), network.community_table(pairs, network.communities(pairs))):
        assert frame.collect() == []
    assert network.summary(pairs).first().n_nodes == 0


# ---- many tests ------------------------------------------------------------


def adjusted(ps):
    """By definition, each p-value against all others."""
    m, order = len(ps), sorted(ps)
    harmonic = sum(1 / i for i in range(1, m + 1))
    for p in ps:
        bh = min(q * m / (j + 1) for j, q in enumerate(order) if q >= p)
        holm = max(q * (m - j) for j, q in enumerate(order) if q <= p and order.index(q) == j)
        yield tuple(min(1.0, x) for x in (p * m, holm, bh, bh * harmonic))


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_corrections_by_definition(spark, partitions):
    rng = random.Random(9)
    families = {"a": [rng.random() ** 3 for _ in range(150)], "b": [0.03] * 70 + [rng.choice([0.0, 0.001, 0.03, 0.5, 1.0]) for _ in range(90)], None: [0.2, 0.01], "one": [0.4]}
    rows = [(f, p, "x", 1.0) for f, ps in families.items() for p in ps] + [("a", None, "x", 1.0), ("a", float("nan"), "x", 1.0), ("none", None, "x", 1.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "family string, p double, _n string, P_BH double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = multiple.adjust(df, "p", ["family"])
        assert got.columns == ["family", "p", "_n", "p_bonferroni", "p_holm", "p_bh", "p_by"]
        found = [tuple(r) for r in got.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    key = lambda r: tuple(str(round(x, 9)) if isinstance(x, float) else str(x) for x in r)
    want = [(f, p, "x", *t) for f, ps in families.items() for p, t in zip(ps, adjusted(ps), strict=True)]
    want += [("a", None, "x") + (None,) * 4, ("a", float("nan"), "x") + (None,) * 4, ("none", None, "x") + (None,) * 4]
    assert sorted(map(key, found)) == sorted(map(key, want))
    assert multiple.adjust(df.limit(0), "p").collect() == []
    alone = multiple.adjust(df.where("family = 'a'").select("p"), "p").where("p_bh IS NOT NULL").select("p_bh").collect()
    assert sorted(round(r.p_bh, 9) for r in alone) == sorted(round(t[2], 9) for t in adjusted(families["a"]))


# ---- rank correlation ------------------------------------------------------


def mean_ranks(values):
    order = sorted(values)
    return [order.index(v) + (order.count(v) + 1) / 2 for v in values]


def test_spearman_by_definition(spark):
    rng = random.Random(3)
    rows = []
    for g in ("u", "v", None):
        for _ in range(130):
            x = rng.choice([1.0, 1.0, 1.0, rng.random()])  # one value holds most rows
            rows.append((g, x, rng.choice([None, x + rng.random(), 0.0, -0.0]), rng.choice([float("nan"), float("inf"), 5.0, float(rng.randrange(6))])))
    rows += [("single", 1.0, 2.0, 3.0), ("flat", 1.0, 2.0, None), ("flat", 1.0, 3.0, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double")
    got = {(r.g, r.a, r.b): (r.n, r.rho) for r in ranks.spearman(df, ["x", "y", "z"], ["g"], digits=9).collect()}
    for g in ("u", "v", None, "single", "flat"):
        for i, j in ((1, 2), (1, 3), (2, 3)):
            both = [(r[i], r[j]) for r in rows if r[0] == g and all(v is not None and not math.isnan(v) for v in (r[i], r[j]))]
            if not both:
                assert (g, "_xyz"[i], "_xyz"[j]) not in got
                continue
            a, b = (np.array(mean_ranks([p[s] for p in both])) for s in (0, 1))
            n, rho = got[g, "_xyz"[i], "_xyz"[j]]
            assert n == len(both)
            assert rho == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-8) if a.std() and b.std() else rho is None
    assert ranks.spearman(df.limit(0), ["x", "y"]).collect() == []


# ---- special functions and group tests -------------------------------------


def area(density, low, high, n=200_000):
    x = low + (np.arange(n) + 0.5) * (high - low) / n
    return float(density(x).sum() * (high - low) / n)


def test_gamma_functions(spark):
    xs = [1e-3, 0.2, 0.5, 1.0, 1.5, 2.0, 7.3, 100.0, 1e4, 1e9]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(special.log_gamma(F.col("x"))).collect()
    assert [r[0] for r in got] == pytest.approx([math.lgamma(x) for x in xs], rel=1e-12, abs=1e-12)
    zs = [0.0, 0.1, 1.0, 1.96, 4.0, 9.0, 30.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select(special.normal_two_sided(F.col("z"))).collect()
    assert [r[0] for r in got] == pytest.approx([math.erfc(z / math.sqrt(2)) for z in zs], rel=1e-9)


def test_tails_by_area(spark):
    cases = [(t, v) for t in (0.0, 0.3, 1.0, 2.228, -5.0, 12.0) for v in (1.0, 2.5, 10.0, 300.0, 5000.0)]
    got = spark.createDataFrame(cases, "t double, v double").select(special.t_two_sided(F.col("t"), F.col("v"))).collect()
    for (t, v), r in zip(cases, got, strict=True):
        scale = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
        assert r[0] == pytest.approx(1 - 2 * area(lambda x: scale * (1 + x * x / v) ** (-(v + 1) / 2), 0, abs(t)) if t else 1, abs=1e-8)  # noqa: B023
    cases = [(x, k) for x in (0.0, 0.5, 3.0, 20.0, 400.0) for k in (2, 4, 10, 300)]
    got = spark.createDataFrame(cases, "x double, k int").select(special.chi_squared_tail(F.col("x"), F.col("k"))).collect()
    for (x, k), r in zip(cases, got, strict=True):
        assert r[0] == pytest.approx(math.exp(-x / 2) * sum(math.exp(i * math.log(x / 2) - math.lgamma(i + 1)) if x else float(i == 0) for i in range(k // 2)), rel=1e-9, abs=1e-14)
    far = spark.range(1).select(special.chi_squared_tail(F.lit(20_300.0), F.lit(20_000)), special.chi_squared_tail(F.lit(9_970.0), F.lit(9_990))).first()
    for r, x, k in zip(far, (20_300.0, 9_970.0), (20_000, 9_990), strict=True):
        assert r == pytest.approx(sum(math.exp(i * math.log(x / 2) - x / 2 - math.lgamma(i + 1)) for i in range(k // 2)), abs=1e-6)


def test_welch_by_definition(spark):
    rng = np.random.default_rng(5)
    rows = [(k, str(g), float(v)) for k in (1, 2) for g, size in (("m", 40), ("f", 9)) for v in rng.normal(k + (g == "m"), 2 if g == "m" else 0.5, size)]
    rows += [(1, "x", 99.0), (1, "m", None), (1, "f", float("nan")), (3, "m", 1.0), (3, "f", 1.0), (4, "m", 2.0), (4, "m", 2.0), (4, "f", 2.0), (4, "f", 2.0), (None, "m", 1.0)]
    got = {r.k: r for r in group_tests.welch(spark.createDataFrame(rows, "k int, g string, v double"), "g", "m", "f", "v", ["k"]).collect()}
    for k in (1, 2):
        a, b = (np.array([v for kk, gg, v in rows if kk == k and gg == g and v is not None and not math.isnan(v)]) for g in "mf")
        x, y = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
        t, dof = (a.mean() - b.mean()) / math.sqrt(x + y), (x + y) ** 2 / (x * x / (len(a) - 1) + y * y / (len(b) - 1))
        scale = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi)
        assert (got[k].n1, got[k].n2) == (len(a), len(b)) and (got[k].t, got[k].dof) == pytest.approx((t, dof))
        assert got[k].p == pytest.approx(1 - 2 * area(lambda u: scale * (1 + u * u / dof) ** (-(dof + 1) / 2), 0, abs(t)), abs=1e-7)  # noqa: B023
    assert all(got[k].t is None and got[k].p is None for k in (3, 4, None))
    assert group_tests.welch(spark.createDataFrame([], "k int, g string, v double"), "g", "m", "f", "v", ["k"]).collect() == []


def test_chi_squared_by_definition(spark):
    rng = random.Random(2)
    rows = [("hot", "hot")] * 300 + [(rng.choice("abc"), rng.choice(["u", "v", "hot"])) for _ in range(200)] + [("rare", "only"), (None, "u"), ("a", None)]
    got = group_tests.chi_squared(spark.createDataFrame(rows, "r string, c string"), "r", "c").first()
    full = [p for p in rows if None not in p]
    cells, r, c = Counter(full), Counter(p[0] for p in full), Counter(p[1] for p in full)
    chi2 = sum((cells[i, j] - r[i] * c[j] / len(full)) ** 2 / (r[i] * c[j] / len(full)) for i in r for j in c)
    assert (got.n, got.dof) == (len(full), (len(r) - 1) * (len(c) - 1)) and got.chi2 == pytest.approx(chi2)
    assert got.cramers_v == pytest.approx(math.sqrt(chi2 / (len(full) * (min(len(r), len(c)) - 1))))
    flat = group_tests.chi_squared(spark.createDataFrame([("a", "u")] * 3 + [("a", "v")], "r string, c string"), "r", "c").first()
    assert (flat.chi2, flat.dof, flat.p, flat.cramers_v) == (0.0, 0, None, None)
    assert group_tests.chi_squared(spark.createDataFrame([], "r string, c string"), "r", "c").collect() == []


def test_exact_tests_by_enumeration(spark):
    tables = [(3, 1, 1, 3), (0, 0, 0, 0), (10, 0, 0, 10), (5, 0, 3, 0), (12, 30, 400, 900), (0, 7, 9, 2), (2, 2, 2, 2)]
    df = spark.createDataFrame(tables, "a long, b long, c long, d long")
    two = [r[0] for r in df.select(special.fisher_two_sided(*map(F.col, "abcd"))).collect()]
    tail = [r[0] for r in df.select(special.hypergeometric_tail(F.col("a"), F.col("a") + F.col("b"), F.col("a") + F.col("c"), F.expr("a + b + c + d"))).collect()]
    for (a, b, c, d), p, q in zip(tables, two, tail, strict=True):
        n, row, col = a + b + c + d, a + b, a + c
        chance = {k: math.comb(col, k) * math.comb(n - col, row - k) / math.comb(n, row) for k in range(max(0, row + col - n), min(row, col) + 1)}
        assert p == pytest.approx(min(1, sum(v for v in chance.values() if v <= chance[a] * (1 + 1e-7))), rel=1e-9)
        assert q == pytest.approx(sum(v for k, v in chance.items() if k >= a), rel=1e-9)
    rows = [(k, x, y) for k, x, y in itertools.product((1, None), (True, False, None), (True, False, None)) for _ in range(3)]
    found = group_tests.fisher(spark.createDataFrame(rows, "k int, x boolean, y boolean"), F.col("x"), F.col("y"), ["k"]).collect()
    assert {(r.k, r.both, r.first_only, r.second_only, r.neither, r.odds_ratio) for r in found} == {(1, 3, 3, 3, 3, 1.0), (None, 3, 3, 3, 3, 1.0)}


def test_poisson_regression_by_newton(spark):
    rng = np.random.default_rng(1)
    x, e = rng.normal(size=400).round(2), rng.uniform(0.5, 3, 400).round(2)
    y = rng.poisson(e * np.exp(0.4 + 0.8 * x)).astype(float)
    rows = [(float(a), float(b), float(c)) for a, b, c in zip(y, x, e, strict=True)] + [(None, 1.0, 1.0), (3.0, None, 1.0), (3.0, 1.0, None), (1.0, 1.0, 0.0), (float("nan"), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "y double, x double, e double")
    got = {r.term: r for r in group_tests.poisson_regression(df, "y", {"x": F.col("x")}, F.col("e")).collect()}
    m, beta = np.c_[np.ones(400), x], np.zeros(2)
    for _ in range(50):
        mu = e * np.exp(m @ beta)
        info = m.T @ (m * mu[:, None])
        beta = beta + np.linalg.solve(info, m.T @ (y - mu))
    errors = np.sqrt(np.diag(np.linalg.inv(info)))
    for i, t in enumerate(("intercept", "x")):
        assert (got[t].estimate, got[t].std_error) == pytest.approx((beta[i], errors[i]), rel=1e-6)
        assert got[t].p == pytest.approx(math.erfc(abs(beta[i] / errors[i]) / math.sqrt(2)), rel=1e-6, abs=1e-300) and got[t].rate_ratio == pytest.approx(math.exp(beta[i]), rel=1e-6)
    for bad, terms in ((df.limit(0), {}), (df, {"a": F.col("x"), "b": 2 * F.col("x")})):
        with pytest.raises(ValueError):
            group_tests.poisson_regression(bad, "y", terms)
