"""Queries for network measures, corrections of many tests, rank correlation and tests between groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.checks.registry import check, table
from tabularium.operators import ecology, enrichment, fits, group_tests, multiple, network, ranks
from tabularium.session import stored

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(df, digits, *names):
    """Columns rounded, halves away from zero; a negative zero becomes zero.

    A double whose shifted value is small and not near a half rounds the same as a whole number: its error is far below what
    keeps it from the half, and the quotient of two whole numbers is the double next to their decimal. Decimals, which are
    many times slower, are left for the others.
    """
    doubles = {f.name for f in df.schema if f.dataType.typeName() == "double"}

    def near(name):
        shifted, exact = F.col(name) * F.lit(10.0 ** digits), F.round(F.col(name), digits)
        if name not in doubles:
            return exact
        whole = F.rint(shifted)
        return F.when((F.abs(shifted) < F.lit(2.0 ** 40)) & (F.abs(shifted - whole) < F.lit(0.499)), whole / F.lit(10.0 ** digits)).otherwise(exact)

    return df.withColumns({n: near(n) + F.lit(0.0) for n in names})


# ---- networks --------------------------------------------------------------

#: Parts on neighbouring lines of an order.
PARTS_SQL = """
e AS MATERIALIZED (
  SELECT DISTINCT least(x.l_partkey, y.l_partkey) AS a, greatest(x.l_partkey, y.l_partkey) AS b
  FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND y.l_linenumber = x.l_linenumber + 1 WHERE x.l_partkey <> y.l_partkey),
w AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
g AS MATERIALIZED (SELECT a AS node, count(*) AS degree FROM w GROUP BY 1)"""

CLUSTERING_SQL = PARTS_SQL + """,
t AS MATERIALIZED (SELECT x.a, x.b, y.b AS c FROM e x JOIN e y ON x.b = y.a JOIN e z ON z.a = x.a AND z.b = y.b),
n AS (SELECT node, count(*) AS n_triangles FROM (SELECT a AS node FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t) GROUP BY 1),
k AS MATERIALIZED (
  SELECT node, degree, coalesce(n_triangles, 0) AS n_triangles,
         CASE WHEN degree > 1 THEN 2.0::DOUBLE * coalesce(n_triangles, 0) / (degree * (degree - 1)) ELSE 0 END AS coefficient
  FROM g LEFT JOIN n USING (node))"""


def part_pairs(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    after = lines.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("next"))
    return network.undirected(lines.join(after, ["l_orderkey", "l_linenumber"]), "l_partkey", "next")


@check("net_degrees", f"WITH {PARTS_SQL} SELECT node, degree FROM g")
def _(spark, d):
    return network.degrees(part_pairs(spark, d))


@check("net_degree_distribution", f"""WITH {PARTS_SQL}, c AS (SELECT degree, count(*) AS n_nodes FROM g GROUP BY 1)
SELECT degree, n_nodes, round(sum(n_nodes) OVER (ORDER BY degree DESC)::DOUBLE / sum(n_nodes) OVER (), 9) AS share_at_least FROM c""")
def _(spark, d):
    return rounded(network.degree_distribution(part_pairs(spark, d)), 9, "share_at_least")


@check("net_hubs", f"""WITH {PARTS_SQL}, l AS (SELECT avg(degree) AS mean, stddev_pop(degree) AS sd FROM g)
SELECT node, degree, round((degree - mean) / sd, 6) AS z FROM g, l WHERE (degree - mean) / sd >= 2""")
def _(spark, d):
    return rounded(network.hubs(part_pairs(spark, d), 2.0), 6, "z")


@check("net_clustering", f"WITH {CLUSTERING_SQL} SELECT node, degree, n_triangles, round(coefficient, 9) AS coefficient FROM k")
def _(spark, d):
    return rounded(network.clustering(part_pairs(spark, d)), 9, "coefficient")


@check("net_summary", f"""WITH {CLUSTERING_SQL}
SELECT count(*) AS n_nodes, (sum(degree) // 2)::BIGINT AS n_edges, round(sum(degree)::DOUBLE / (count(*) * (count(*) - 1)), 9) AS density, round(avg(degree), 9) AS mean_degree,
  max(degree) AS max_degree, (sum(n_triangles) // 3)::BIGINT AS n_triangles, round(sum(n_triangles) / sum(degree * (degree - 1) / 2.0::DOUBLE), 9) AS transitivity,
  round(avg(coefficient), 9) AS mean_clustering FROM k""")
def _(spark, d):
    return rounded(network.summary(part_pairs(spark, d)), 9, "density", "mean_degree", "transitivity", "mean_clustering")


@check("net_components", """
WITH RECURSIVE e AS (SELECT 'C' || c_custkey AS a, 'N' || c_nationkey AS b FROM customer UNION SELECT 'S' || s_suppkey, 'N' || s_nationkey FROM supplier),
w AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS low FROM w UNION SELECT w.b, r.low FROM r JOIN w ON w.a = r.node WHERE r.low < w.b)
SELECT node, min(low) AS component FROM r GROUP BY 1""")
def _(spark, d):
    def ends(name, letter, key, nation):
        return table(spark, d, name).select(F.concat(F.lit(letter), key).alias("x"), F.concat(F.lit("N"), nation).alias("y"))
    links = ends("customer", "C", "c_custkey", "c_nationkey").union(ends("supplier", "S", "s_suppkey", "s_nationkey"))
    return network.components(network.undirected(links, "x", "y"))


ROUNDS = 3
COMMUNITIES_SQL = PARTS_SQL + ", p0 AS MATERIALIZED (SELECT node, node AS community FROM g)" + "".join(f""",
v{i} AS (SELECT node, community, count(*) AS n FROM (SELECT w.a AS node, p.community FROM w JOIN p{i} p ON p.node = w.b UNION ALL SELECT node, community FROM p{i}) GROUP BY 1, 2),
p{i + 1} AS MATERIALIZED (SELECT node, community FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY n DESC, community) AS k FROM v{i}) WHERE k = 1)""" for i in range(ROUNDS))


@check("net_communities", f"WITH {COMMUNITIES_SQL} SELECT node, community FROM p{ROUNDS}")
def _(spark, d):
    return network.communities(part_pairs(spark, d), ROUNDS)


@check("net_community_table", f"""WITH {COMMUNITIES_SQL},
i AS (SELECT x.community, count(*) AS n_inside FROM e JOIN p{ROUNDS} x ON x.node = e.a JOIN p{ROUNDS} y ON y.node = e.b WHERE x.community = y.community GROUP BY 1),
s AS (SELECT community, count(*) AS n_nodes, sum(degree)::BIGINT AS n_ends FROM g JOIN p{ROUNDS} USING (node) GROUP BY 1)
SELECT community, n_nodes, coalesce(n_inside, 0) AS n_inside, n_ends,
  round(coalesce(n_inside, 0) / (SELECT count(*) FROM e)::DOUBLE - (n_ends / (2.0::DOUBLE * (SELECT count(*) FROM e))) ** 2, 9) AS modularity FROM s LEFT JOIN i USING (community)""")
def _(spark, d):
    pairs = stored(part_pairs(spark, d), "edges")
    return rounded(network.community_table(pairs, network.communities(pairs, ROUNDS)), 9, "modularity")


# ---- many tests ------------------------------------------------------------

P_VALUE = "least(1.0, l_extendedprice / 100000)"


@check("multiple_tests", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_returnflag, {P_VALUE.replace("1.0", "1.0::DOUBLE")} AS p FROM lineitem),
j AS (SELECT *, count(*) OVER (PARTITION BY l_returnflag) AS m, count(*) OVER (PARTITION BY l_returnflag ORDER BY p) AS last,
        rank() OVER (PARTITION BY l_returnflag ORDER BY p) AS first FROM t),
r AS (SELECT *, min(p * m / last) OVER (PARTITION BY l_returnflag ORDER BY p DESC) AS bh, max(p * (m - first + 1)) OVER (PARTITION BY l_returnflag ORDER BY p) AS holm FROM j),
h AS (SELECT l_returnflag, m, list_sum(list_transform(range(1, m + 1), lambda i: 1.0::DOUBLE / i)) AS harmonic FROM (SELECT DISTINCT l_returnflag, m FROM j))
SELECT l_orderkey, l_linenumber, l_returnflag, p, round(least(p * m, 1), 9) AS p_bonferroni, round(least(holm, 1), 9) AS p_holm, round(least(bh, 1), 9) AS p_bh,
  round(least(bh * harmonic, 1), 9) AS p_by FROM r JOIN h USING (l_returnflag, m)""")
def _(spark, d):
    tests = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.expr(P_VALUE).alias("p"))
    return rounded(multiple.adjust(tests, "p", ["l_returnflag"]), 9, "p_bonferroni", "p_holm", "p_bh", "p_by")


# ---- rank correlation ------------------------------------------------------

RANK_PAIRS = [(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[i + 1:]]


@check("rank_correlation", "WITH " + ", ".join(f"""r{i} AS (SELECT l_returnflag, l_linestatus,
  rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY {a}) + (count(*) OVER (PARTITION BY l_returnflag, l_linestatus, {a}) - 1) / 2.0::DOUBLE AS x,
  rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY {b}) + (count(*) OVER (PARTITION BY l_returnflag, l_linestatus, {b}) - 1) / 2.0::DOUBLE AS y
  FROM lineitem WHERE {a} IS NOT NULL AND {b} IS NOT NULL)""" for i, (a, b) in enumerate(RANK_PAIRS)) + " UNION ALL ".join(
    f" SELECT l_returnflag, l_linestatus, '{a}' AS a, '{b}' AS b, count(*) AS n, round(corr(x, y), 6) + 0.0 AS rho FROM r{i} GROUP BY 1, 2" for i, (a, b) in enumerate(RANK_PAIRS)))
def _(spark, d):
    return rounded(ranks.spearman(table(spark, d, "lineitem"), MEASURES, ["l_returnflag", "l_linestatus"]), 6, "rho")


# ---- tests between groups --------------------------------------------------

#: Areas under densities by midpoints: share of the beta distribution with b = 1/2, and the normal distribution.
BETA_HALF_SQL = """
(SELECT sum(exp((2 * {a} - 1) * ln(sin((k + 0.5) / 20000 * asin(sqrt({x})))) + ln(2) + lgamma({a} + 0.5) - lgamma({a}) - lgamma(0.5))) * asin(sqrt({x})) / 20000
 FROM range(20000) r(k))"""
NORMAL_SQL = "(1 - (SELECT sum(exp(-0.5 * pow((k + 0.5) / 20000 * abs({z}), 2))) * abs({z}) / 20000 * sqrt(2 / pi()) FROM range(20000) r(k)))"


@check("welch_by_priority", f"""
WITH g AS (SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n1, count(*) FILTER (o_orderstatus = 'O') AS n2, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS mean1,
  avg(o_totalprice) FILTER (o_orderstatus = 'O') AS mean2, var_samp(o_totalprice) FILTER (o_orderstatus = 'F') AS v1, var_samp(o_totalprice) FILTER (o_orderstatus = 'O') AS v2 FROM orders GROUP BY 1),
s AS (SELECT *, (mean1 - mean2) / sqrt(v1 / n1 + v2 / n2) AS t, (v1 / n1 + v2 / n2) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v2 / n2) ** 2 / (n2 - 1)) AS dof FROM g)
SELECT o_orderpriority, n1, n2, round(mean1, 4) AS mean1, round(mean2, 4) AS mean2, round(t, 6) AS t, round(dof, 4) AS dof, round({BETA_HALF_SQL.format(a="dof / 2", x="dof / (dof + t * t)")}, 4) AS p FROM s""")
def _(spark, d):
    found = group_tests.welch(table(spark, d, "orders"), "o_orderstatus", "F", "O", "o_totalprice", ["o_orderpriority"])
    return rounded(rounded(found, 6, "t"), 4, "dof", "p", "mean1", "mean2")


@check("chi_squared_status", """
WITH c AS (SELECT o_orderstatus AS r, o_orderpriority AS c, count(*) AS o FROM orders GROUP BY 1, 2),
f AS (SELECT x.r, y.c, coalesce(o, 0) AS o, (SELECT sum(o) FROM c WHERE c.r = x.r) * (SELECT sum(o) FROM c WHERE c.c = y.c)::DOUBLE / (SELECT sum(o) FROM c) AS e
      FROM (SELECT DISTINCT r FROM c) x CROSS JOIN (SELECT DISTINCT c FROM c) y LEFT JOIN c ON c.r = x.r AND c.c = y.c),
s AS (SELECT sum(o)::BIGINT AS n, sum((o - e) ** 2 / e) AS chi2, ((count(DISTINCT r) - 1) * (count(DISTINCT c) - 1))::BIGINT AS dof, least(count(DISTINCT r), count(DISTINCT c)) - 1 AS less FROM f)
SELECT n, round(chi2, 6) AS chi2, dof, round(exp(-chi2 / 2) * (SELECT sum((chi2 / 2) ** i / gamma(i + 1)) FROM range(dof // 2) t(i)), 6) AS p, round(sqrt(chi2 / (n * less)), 6) AS cramers_v FROM s""")
def _(spark, d):
    return rounded(group_tests.chi_squared(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority"), 6, "chi2", "p", "cramers_v")


@check("fisher_by_nation", """
WITH f AS (SELECT c_nationkey, c_mktsegment = 'BUILDING' AS x, c_acctbal > 5000 AS y FROM customer),
g AS (SELECT c_nationkey, count(*) FILTER (x AND y) AS "both", count(*) FILTER (x AND NOT y) AS first_only, count(*) FILTER (NOT x AND y) AS second_only, count(*) FILTER (NOT x AND NOT y) AS neither FROM f GROUP BY 1),
k AS (SELECT *, "both" + first_only AS r, "both" + second_only AS c, "both" + first_only + second_only + neither AS n FROM g),
l AS (SELECT c_nationkey, i, lgamma(c + 1) - lgamma(i + 1) - lgamma(c - i + 1) + lgamma(n - c + 1) - lgamma(r - i + 1) - lgamma(n - c - r + i + 1) - lgamma(n + 1) + lgamma(r + 1) + lgamma(n - r + 1) AS lp
      FROM (SELECT *, unnest(range(greatest(0, r + c - n), least(r, c) + 1)) AS i FROM k)),
p AS (SELECT l.c_nationkey, sum(exp(l.lp)) FILTER (l.lp <= o.lp + 1e-7) AS p FROM l JOIN (SELECT l.c_nationkey, lp FROM l JOIN k ON k.c_nationkey = l.c_nationkey AND i = "both") o ON o.c_nationkey = l.c_nationkey GROUP BY 1)
SELECT c_nationkey, "both", first_only, second_only, neither, round(CASE WHEN first_only * second_only > 0 THEN "both"::DOUBLE * neither / (first_only * second_only) END, 6) AS odds_ratio, round(least(p, 1), 6) AS p
FROM k JOIN p USING (c_nationkey)""")
def _(spark, d):
    found = group_tests.fisher(table(spark, d, "customer"), F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") > 5000, ["c_nationkey"])
    return rounded(found, 6, "odds_ratio", "p")


@check("poisson_by_segment", f"""
WITH y AS (SELECT c_mktsegment AS g, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment),
m AS (SELECT g, avg(n) AS mean, sum(n) AS total FROM y GROUP BY 1),
t AS (SELECT 'intercept' AS term, ln(mean) AS estimate, 1 / sqrt(total) AS std_error FROM m WHERE g = 'AUTOMOBILE'
  UNION ALL SELECT m.g, ln(m.mean / b.mean), sqrt(1 / m.total + 1 / b.total) FROM m, (SELECT * FROM m WHERE g = 'AUTOMOBILE') b WHERE m.g <> 'AUTOMOBILE')
SELECT term, round(estimate, 6) AS estimate, round(std_error, 6) AS std_error, round(estimate / std_error, 5) AS z, round({NORMAL_SQL.format(z="(estimate / std_error)")}, 5) + 0.0 AS p,
  round(exp(estimate), 6) AS rate_ratio FROM t""")
def _(spark, d):
    counts = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey", "c_mktsegment").agg(F.count("o_orderkey").alias("n"))
    segments = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    found = group_tests.poisson_regression(counts, "n", {s: (F.col("c_mktsegment") == s).cast("double") for s in segments})
    return rounded(rounded(found, 6, "estimate", "std_error", "rate_ratio"), 5, "z", "p")


# ---- sets ------------------------------------------------------------------

#: Suppliers as sets of parts; parts of the dearest lines are the selection.
SUPPLIED_SQL = "m AS MATERIALIZED (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem), z AS MATERIALIZED (SELECT s, count(*) AS size FROM m GROUP BY 1)"


@check("set_enrichment", f"""
WITH {SUPPLIED_SQL}, c AS (SELECT DISTINCT l_partkey AS p FROM lineitem WHERE l_extendedprice >= 90000),
t AS (SELECT (SELECT count(DISTINCT p) FROM m) AS total, (SELECT count(*) FROM c) AS drawn),
h AS (SELECT s, size, (SELECT count(*) FROM m JOIN c USING (p) WHERE m.s = z.s) AS hits FROM z),
x AS (SELECT s, hits, size, total, drawn, unnest(range(greatest(hits, drawn + size - total), least(size, drawn) + 1)) AS i FROM h, t),
v AS (SELECT s, least(1, sum(exp(lgamma(size + 1) - lgamma(i + 1) - lgamma(size - i + 1) + lgamma(total - size + 1) - lgamma(drawn - i + 1) - lgamma(total - size - drawn + i + 1)
        - lgamma(total + 1) + lgamma(drawn + 1) + lgamma(total - drawn + 1)))) AS p FROM x GROUP BY 1),
j AS (SELECT s, p, count(*) OVER () AS m, count(*) OVER (ORDER BY p) AS last FROM v),
b AS (SELECT s, p, least(1, p * m) AS bonferroni, least(1, min(p * m / last) OVER (ORDER BY p DESC)) AS bh FROM j)
SELECT s AS "set", size, hits, round(size * drawn / total::DOUBLE, 6) AS expected, round(hits / (size * drawn / total::DOUBLE), 6) AS fold, round(p, 6) AS p, round(bonferroni, 5) AS p_bonferroni,
  round(bh, 5) AS p_bh FROM h JOIN b USING (s), t""")
def _(spark, d):
    lines = table(spark, d, "lineitem")
    found = enrichment.over_representation(lines, "l_suppkey", "l_partkey", lines.where("l_extendedprice >= 90000"))
    return rounded(rounded(found, 6, "expected", "fold", "p"), 5, "p_bonferroni", "p_bh")


@check("set_overlaps", f"""
WITH {SUPPLIED_SQL}, o AS (SELECT x.s AS a, y.s AS b, count(*) AS shared FROM m x JOIN m y ON x.p = y.p AND x.s < y.s GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT a, b, shared, round(shared / (x.size + y.size - shared)::DOUBLE, 9) AS jaccard FROM o JOIN z x ON x.s = a JOIN z y ON y.s = b""")
def _(spark, d):
    return rounded(enrichment.set_overlaps(table(spark, d, "lineitem"), "l_suppkey", "l_partkey", 3), 9, "jaccard")


# ---- diversity -------------------------------------------------------------

#: Suppliers as samples, brands as taxa.
BRANDS_SQL = """
a AS MATERIALIZED (SELECT l_suppkey AS sample, p_brand AS taxon, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
t AS MATERIALIZED (SELECT sample, sum(n)::BIGINT AS total FROM a GROUP BY 1)"""


def brands(spark, d):
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return ecology.abundances(lines, "l_suppkey", "p_brand")


@check("eco_diversity", f"""
WITH {BRANDS_SQL}, p AS (SELECT sample, n, total, n / total::DOUBLE AS p FROM a JOIN t USING (sample))
SELECT sample, count(*) AS richness, any_value(total) AS total, round(-sum(p * ln(p)), 9) AS shannon, round(1 - sum(p * p), 9) AS simpson, round(1 / sum(p * p), 6) AS inverse_simpson,
  round(CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) END, 9) AS evenness,
  round(count(*) + count(*) FILTER (n = 1) * (count(*) FILTER (n = 1) - 1) / (2.0::DOUBLE * (count(*) FILTER (n = 2) + 1)), 6) AS chao1 FROM p GROUP BY 1""")
def _(spark, d):
    return rounded(rounded(ecology.diversity(brands(spark, d)), 9, "shannon", "simpson", "evenness"), 6, "inverse_simpson", "chao1")


@check("eco_bray_curtis", f"""
WITH {BRANDS_SQL}, l AS (SELECT x.sample AS a, y.sample AS b, sum(least(x.n, y.n))::BIGINT AS shared FROM a x JOIN a y ON x.taxon = y.taxon AND x.sample < y.sample GROUP BY 1, 2)
SELECT a, b, shared, round(1 - 2 * shared / (x.total + y.total)::DOUBLE, 9) AS distance FROM l JOIN t x ON x.sample = a JOIN t y ON y.sample = b""")
def _(spark, d):
    return rounded(ecology.bray_curtis(brands(spark, d)), 9, "distance")


@check("eco_centred_log_ratio", f"""
WITH {BRANDS_SQL}, k AS (SELECT s.sample, b.taxon, coalesce(a.n, 0) AS n FROM (SELECT DISTINCT sample FROM a) s CROSS JOIN (SELECT DISTINCT taxon FROM a) b LEFT JOIN a ON a.sample = s.sample AND a.taxon = b.taxon),
c AS (SELECT *, ln(n + 0.5) - avg(ln(n + 0.5)) OVER (PARTITION BY sample) AS clr, ln(0.5) - avg(ln(n + 0.5)) OVER (PARTITION BY sample) AS clr_absent FROM k)
SELECT sample, taxon, n, round(clr, 6) + 0.0 AS clr, round(clr_absent, 6) + 0.0 AS clr_absent FROM c WHERE n > 0""")
def _(spark, d):
    return rounded(ecology.centred_log_ratio(brands(spark, d), 0.5), 6, "clr", "clr_absent")


@check("eco_rarefaction", f"""
WITH {BRANDS_SQL}
SELECT sample, any_value(total) AS total, round(CASE WHEN any_value(total) >= 50 THEN sum(1 - CASE WHEN total - n >= 50 THEN
  exp(lgamma(total - n + 1) - lgamma(total - n - 50 + 1) - lgamma(total + 1) + lgamma(total - 50 + 1)) ELSE 0 END) END, 6) AS expected FROM a JOIN t USING (sample) GROUP BY 1""")
def _(spark, d):
    return rounded(ecology.rarefied_richness(brands(spark, d), 50), 6, "expected")


# ---- fits ------------------------------------------------------------------


@check("fit_power_law", f"""
WITH h AS MATERIALIZED (SELECT n_chars::DOUBLE AS x, count(*) AS n FROM documents WHERE n_chars > 0 GROUP BY 1),
g AS (SELECT min(x) AS low, max(x) AS high, count(*) AS k FROM h),
c AS MATERIALIZED (SELECT DISTINCT x AS cut FROM h, g WHERE k <= {fits.CUTS}
  UNION SELECT (SELECT min(x) FROM h WHERE x >= low * pow(high / low, i / {fits.CUTS}.0::DOUBLE)) FROM g, range({fits.CUTS}) t(i) WHERE k > {fits.CUTS}),
l AS MATERIALIZED (SELECT cut, sum(n)::BIGINT AS n_tail, 1 + sum(n) / sum(n * ln(x / (cut - 0.5))) AS alpha FROM c JOIN h ON x >= cut GROUP BY 1 HAVING count(*) > 1),
s AS (SELECT cut, n_tail, alpha, abs(sum(n) OVER (PARTITION BY cut ORDER BY x)::DOUBLE / n_tail - (1 - pow((x + 0.5) / (cut - 0.5), 1 - alpha))) AS gap FROM l JOIN h ON x >= cut),
k AS (SELECT cut, any_value(n_tail) AS n_tail, any_value(alpha) AS alpha, max(gap) AS ks FROM s GROUP BY 1)
SELECT cut, n_tail, round(alpha, 6) AS alpha, round(ks, 6) AS ks, row_number() OVER (ORDER BY ks, cut) = 1 AS best FROM k""")
def _(spark, d):
    return rounded(fits.power_law(table(spark, d, "documents"), "n_chars"), 6, "alpha", "ks")


@check("fit_tails", """
WITH d AS (SELECT n_chars::DOUBLE AS x, ln(n_chars) AS l FROM documents WHERE n_chars > 0),
s AS (SELECT count(*) AS n, min(x) AS low, avg(l) AS mean, stddev_pop(l) AS sd, avg(x) AS middle, 1 + count(*) / sum(l - (SELECT min(l) FROM d)) AS alpha FROM d),
m AS (SELECT 'power law' AS model, alpha AS first, low AS second, (SELECT sum(ln((alpha - 1) / low) - alpha * (l - ln(low))) FROM d) AS ll, 2 AS k FROM s
  UNION ALL SELECT 'log-normal', mean, sd, (SELECT sum(-l - ln(sd * sqrt(2 * pi())) - (l - mean) ** 2 / (2 * sd * sd)) FROM d), 2 FROM s
  UNION ALL SELECT 'exponential', 1 / middle, NULL, (SELECT sum(-ln(middle) - x / middle) FROM d), 1 FROM s)
SELECT model, round(first, 6) AS first, round(second, 6) AS second, round(ll, 3) AS log_likelihood, round(2 * k - 2 * ll, 3) AS aic FROM m""")
def _(spark, d):
    return rounded(rounded(fits.compare_tails(table(spark, d, "documents"), "n_chars"), 6, "first", "second"), 3, "log_likelihood", "aic")


@check("fit_zipf", """
WITH c AS (SELECT w, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1),
r AS (SELECT ln(row_number() OVER (ORDER BY n DESC, w)) AS x, ln(n) AS y, n FROM c WHERE w IS NOT NULL)
SELECT count(*) AS n_values, sum(n)::BIGINT AS total, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(regr_r2(y, x), 6) AS r2 FROM r""")
def _(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.split("text", " ", -1)).alias("w"))
    return rounded(fits.zipf(words, "w"), 6, "slope", "intercept", "r2")


REPLICATES = 40


@check("bootstrap_by_priority", f"""
WITH h AS (SELECT o_orderpriority, o_totalprice AS v, ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT AS s, ('0x' || substr(md5(o_orderkey::VARCHAR), 9, 8))::BIGINT AS t FROM orders WHERE o_totalprice IS NOT NULL),
u AS (SELECT o_orderpriority, v, r, ((s + r * t) % 4294967296) / 4294967296.0::DOUBLE AS u FROM h, range(1, {REPLICATES + 1}) x(r)),
w AS (SELECT o_orderpriority, v, r, {" + ".join(f"(u >= {s!r}::DOUBLE)::INT" for s in fits.POISSON_SHARES)} AS w FROM u),
m AS (SELECT o_orderpriority, r, sum(v * w) / sum(w) AS mean FROM w GROUP BY 1, 2)
SELECT o_orderpriority, (SELECT count(*) FROM h WHERE h.o_orderpriority = m.o_orderpriority) AS n, round((SELECT avg(v) FROM h WHERE h.o_orderpriority = m.o_orderpriority), 4) AS mean,
  round(quantile_cont(mean, 0.025), 4) AS low, round(quantile_cont(mean, 0.975), 4) AS high FROM m GROUP BY 1""")
def _(spark, d):
    return rounded(fits.bootstrap_mean(table(spark, d, "orders"), "o_totalprice", "o_orderkey", ["o_orderpriority"], REPLICATES), 4, "mean", "low", "high")


@check("fit_growth", """
WITH y AS (SELECT year(o_orderdate)::DOUBLE AS x, ln(count(*)) AS y FROM orders GROUP BY 1), f AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i, regr_r2(y, x) AS r FROM y)
SELECT 'rate' AS kind, NULL::DOUBLE AS time, round(s, 6) + 0.0 AS value FROM f UNION ALL SELECT 'doubling', NULL, round(ln(2) / s, 3) FROM f UNION ALL SELECT 'r2', NULL, round(r, 6) FROM f
UNION ALL SELECT 'forecast', 2005, round(exp(i + s * 2005), 3) FROM f""")
def _(spark, d):
    years = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    found = fits.exponential_growth(years, "year", "n", [2005])
    digits = F.when(F.col("kind").isin("rate", "r2"), F.round("value", 6)).otherwise(F.round("value", 3))
    return found.select("kind", "time", (digits + F.lit(0.0)).alias("value"))
