"""Queries for motifs, sequences, profiles, combined evidence and survival."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.checks.declared import rounded
from tabularium.checks.nested import MOTIF_SQL, motif_of
from tabularium.checks.registry import check, table
from tabularium.operators import evidence, motifs, pairs, profiles, sequences, survival

# ---- motifs ----------------------------------------------------------------


def matrices(parts):
    """Key, name and matrix of the well-formed motifs, with the columns that they are made of."""
    made_of = ("p_name", "p_size", "p_type")
    return motif_of(parts, *made_of).select("p_partkey", *made_of, motifs.positions(*map(F.col, "ACGT")).alias("m")).where("m IS NOT NULL")


def first_of_name(parts):
    """Name and matrix of each name's well-formed motif with the least key.

    The part is chosen by key before its matrix is kept, so matrices of the other parts are neither sorted nor joined.
    """
    first = matrices(parts).groupBy("p_name").agg(F.min(F.struct("p_partkey", "p_size", "p_type")).alias("_first")).select("p_name", "_first.*")
    return matrices(first).select("p_name", "m")


@check("motif_weights", f"""
WITH {MOTIF_SQL}, t AS (SELECT p_partkey, pos, sum(n) AS total FROM long GROUP BY 1, 2)
SELECT p_partkey, pos, base, round(log2((n + 0.8 * b) / (total + 0.8) / b), 6) + 0.0 AS weight
FROM long JOIN t USING (p_partkey, pos) JOIN (VALUES ('A', 0.3::DOUBLE), ('C', 0.2), ('G', 0.2), ('T', 0.3)) g(base, b) USING (base)""")
def _(spark, d):
    rows = matrices(table(spark, d, "part")).select("p_partkey", F.posexplode(motifs.log_odds(F.col("m"), 0.8, (0.3, 0.2, 0.2, 0.3))).alias("pos", "w"))
    cells = F.inline(F.array(*[F.struct(F.lit(b).alias("base"), F.col("w")[i].alias("weight")) for i, b in enumerate("ACGT")]))
    return rounded(rows.select("p_partkey", "pos", cells), 6, "weight")


@check("motif_information", f"""
WITH {MOTIF_SQL}, p AS (SELECT p_partkey, pos, n / sum(n) OVER (PARTITION BY p_partkey, pos) AS p FROM long)
SELECT p_partkey, pos, round(2 + sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END), 6) + 0.0 AS bits FROM p GROUP BY 1, 2""")
def _(spark, d):
    rows = matrices(table(spark, d, "part")).select("p_partkey", F.posexplode(motifs.information(F.col("m"))).alias("pos", "bits"))
    return rounded(rows, 6, "bits")


@check("motif_similarity", f"""
WITH {MOTIF_SQL}, f AS (SELECT min(p_partkey) AS p_partkey, p_name FROM part WHERE p_type <> 'SMALL' AND p_size <> 13 GROUP BY 2),
u AS (SELECT p_name, split_part(p_name, ' ', 2) AS family, pos, base, n / sum(n) OVER (PARTITION BY p_partkey, pos) - 0.25 AS x, length(p_name)::INTEGER AS len FROM long JOIN f USING (p_partkey)),
v AS (SELECT '+' AS strand, * FROM u UNION ALL SELECT '-', p_name, family, len - 1 - pos, CASE base WHEN 'A' THEN 'T' WHEN 'C' THEN 'G' WHEN 'G' THEN 'C' ELSE 'A' END, x, len FROM u),
c AS (SELECT a.p_name AS a, b.p_name AS b, b.strand, a.pos - b.pos AS "offset", any_value(a.len) AS n, any_value(b.len) AS m, a.pos,
        coalesce(sum(a.x * b.x) / nullif(sqrt(sum(a.x * a.x) * sum(b.x * b.x)), 0), 0) AS r
      FROM u a JOIN v b ON a.family = b.family AND a.p_name < b.p_name AND a.base = b.base GROUP BY a.p_name, b.p_name, b.strand, a.pos, b.pos),
s AS (SELECT a, b, strand, "offset", round(avg(r), 9) AS score, count(*) AS length FROM c GROUP BY 1, 2, 3, 4 HAVING count(*) >= least(3, any_value(n), any_value(m)))
SELECT a, b, round(score, 6) + 0.0 AS score, "offset", strand FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY score DESC, length DESC, strand, "offset") AS k FROM s) WHERE k = 1""")
def _(spark, d):
    named = first_of_name(table(spark, d, "part")).withColumn("family", F.split_part("p_name", F.lit(" "), F.lit(2)))
    both = pairs.pairs_by_key(named, "family", "p_name", ["m"])
    return rounded(both.select("a", "b", motifs.similarity(F.col("a_m"), F.col("b_m")).alias("s")).select("a", "b", "s.score", "s.offset", "s.strand"), 6, "score")


# ---- sequences -------------------------------------------------------------

BACKGROUND = {"E": 0.12, "T": 0.09, "A": 0.08, "O": 0.07}


@check("seq_composition", """
WITH l AS (SELECT lang, upper(unnest(regexp_extract_all(text, '[A-Za-z]'))) AS residue FROM documents),
c AS (SELECT lang, residue, count(*) AS n FROM l GROUP BY 1, 2), s AS (SELECT *, n / sum(n) OVER (PARTITION BY lang) AS share FROM c)
SELECT lang, residue, n, round(share, 9) AS share, round(log2(share / b), 6) + 0.0 AS enrichment FROM s LEFT JOIN (VALUES ('E', 0.12::DOUBLE), ('T', 0.09), ('A', 0.08), ('O', 0.07)) g(residue, b) USING (residue)""")
def _(spark, d):
    found = sequences.composition(table(spark, d, "documents"), "text", ["lang"], BACKGROUND)
    return rounded(rounded(found, 9, "share"), 6, "enrichment")


@check("seq_contiguity", """
WITH r AS (SELECT source, n_chars, sum(n_chars) OVER w AS upto, row_number() OVER w AS k, sum(n_chars) OVER (PARTITION BY source) AS total
  FROM documents WHERE n_chars > 0 WINDOW w AS (PARTITION BY source ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING))
SELECT source, count(*) AS n_pieces, any_value(total)::BIGINT AS total, max(n_chars) AS longest, max(n_chars) FILTER (upto >= total * 0.5) AS n_length, min(k) FILTER (upto >= total * 0.5) AS n_pieces_to FROM r GROUP BY 1""")
def _(spark, d):
    return sequences.contiguity(table(spark, d, "documents"), "n_chars", ["source"])


#: Lines as genes: two regions, one start per order line, as long as their quantity says.
GENES = ("l_linestatus AS region", "l_orderkey * 40 + l_linenumber * 7 + 1 AS s", "l_orderkey * 40 + l_linenumber * 7 + CAST(l_quantity AS BIGINT) * 3 AS e")


@check("seq_gene_density", f"""
WITH g AS (SELECT {", ".join(GENES)} FROM lineitem), i AS (SELECT *, max(e) OVER (PARTITION BY region ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM g WHERE e >= s AND s >= 1),
k AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY region ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM i),
m AS (SELECT region, min(s) AS s, max(e) AS e FROM k GROUP BY region, island),
c AS (SELECT region, b AS bin, sum(least(e, (b + 1) * 1000) - greatest(s, b * 1000 + 1) + 1) AS covered FROM (SELECT *, unnest(range((s - 1) // 1000, (e - 1) // 1000 + 1)) AS b FROM m) GROUP BY 1, 2),
n AS (SELECT region, b AS bin, count(*) AS n_genes FROM (SELECT region, unnest(range((s - 1) // 1000, (e - 1) // 1000 + 1)) AS b FROM g WHERE e >= s AND s >= 1) GROUP BY 1, 2)
SELECT region, bin, bin * 1000 + 1 AS bin_start, n_genes, covered::BIGINT AS covered, round(covered / 1000, 6) AS share FROM c JOIN n USING (region, bin)""")
def _(spark, d):
    genes = table(spark, d, "lineitem").selectExpr(*GENES)
    return rounded(sequences.gene_density(genes, "region", "s", "e", 1000), 6, "share")


# ---- profiles --------------------------------------------------------------


@check("profile_terms", """
WITH c AS (SELECT source AS document, w AS term, count(*) AS tf FROM (SELECT source, unnest(string_split(text, ' ')) AS w FROM documents) WHERE source IS NOT NULL GROUP BY 1, 2),
w AS (SELECT *, count(*) OVER (PARTITION BY term) AS df, tf * ln((SELECT count(DISTINCT document) FROM c)::DOUBLE / count(*) OVER (PARTITION BY term)) AS w FROM c),
l AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY document)) AS weight FROM w)
SELECT document, term, tf, df, round(weight, 9) AS weight, k::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY document ORDER BY round(weight, 12) DESC, term) AS k FROM l) WHERE k <= 5""")
def _(spark, d):
    words = table(spark, d, "documents").select("source", F.explode(F.split("text", " ", -1)).alias("w"))
    weights = profiles.tf_idf(words, "source", "w")
    return rounded(profiles.top_terms(weights.withColumn("weight", F.round("weight", 12)), 5), 9, "weight")


#: The widest axis by repeated multiplication with the covariance matrix.
AXIS = ("l_quantity", "l_extendedprice", "l_discount")


@check("profile_components", f"""
WITH RECURSIVE m AS (SELECT {", ".join(f"covar_samp({a}, {b}) AS c{i}{j}" for i, a in enumerate(AXIS) for j, b in enumerate(AXIS))} FROM lineitem),
p(k, v0, v1, v2) AS (SELECT 0, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE UNION ALL
  SELECT k + 1, x0 / sqrt(x0 * x0 + x1 * x1 + x2 * x2), x1 / sqrt(x0 * x0 + x1 * x1 + x2 * x2), x2 / sqrt(x0 * x0 + x1 * x1 + x2 * x2)
  FROM (SELECT k, {", ".join(f"c{i}0 * v0 + c{i}1 * v1 + c{i}2 * v2 AS x{i}" for i in range(3))} FROM p, m WHERE k < 60)),
f AS (SELECT v0, v1, v2, {" + ".join(f"c{i}{j} * v{i} * v{j}" for i in range(3) for j in range(3))} AS variance, c00 + c11 + c22 AS total FROM p, m WHERE k = 60)
{" UNION ALL ".join(f"SELECT 1 AS component, round(variance, 2) AS variance, round(variance / total, 6) AS share, '{c}' AS column, round(v{i}, 6) + 0.0 AS loading FROM f" for i, c in enumerate(AXIS))}""")
def _(spark, d):
    found, _ = profiles.principal_components(table(spark, d, "lineitem"), AXIS, 1)
    return rounded(rounded(found, 2, "variance"), 6, "share", "loading")


KM_ROUNDS = 4
KM_SQL = """
x AS MATERIALIZED (SELECT p_partkey AS key, p_size::DOUBLE AS x, p_retailprice / 50 AS y FROM part WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY key) - 1)::INTEGER AS i, x, y FROM (SELECT x, y, min(key) AS key FROM x GROUP BY 1, 2 ORDER BY key LIMIT 5))""" + "".join(f""",
a{r} AS MATERIALIZED (SELECT key, x, y, best.i AS i, sqrt(best.d) AS d FROM (
  SELECT x.key, x.x, x.y, min({{'d': (x.x - c.x) * (x.x - c.x) + (x.y - c.y) * (x.y - c.y), 'i': c.i}}) AS best FROM x, c{r} c GROUP BY 1, 2, 3))""" + (f""",
c{r + 1} AS MATERIALIZED (SELECT c.i, coalesce(m.x, c.x) AS x, coalesce(m.y, c.y) AS y FROM c{r} c LEFT JOIN (SELECT i, avg(x) AS x, avg(y) AS y FROM a{r} GROUP BY 1) m USING (i))""" if r < KM_ROUNDS else "") for r in range(KM_ROUNDS + 1))


@check("profile_clusters", f"WITH {KM_SQL} SELECT key AS p_partkey, i AS cluster, round(d, 6) AS distance FROM a{KM_ROUNDS}")
def _(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_size", (F.col("p_retailprice") / 50).alias("price"))
    return rounded(profiles.k_means(rows, "p_partkey", ["p_size", "price"], 5, KM_ROUNDS)[0], 6, "distance")


# ---- evidence --------------------------------------------------------------

PRIOR = 0.041


@check("evidence_channels", f"""
SELECT l_orderkey, l_linenumber, round(greatest(0, (1 - (1 - l_discount) * (1 - l_tax) - {PRIOR}) / (1 - {PRIOR})), 9) AS combined FROM lineitem""")
def _(spark, d):
    return rounded(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", evidence.combine_channels([F.col("l_discount"), F.col("l_tax")], PRIOR).alias("combined")), 9, "combined")


@check("evidence_rows", f"""
SELECT l_partkey, count(*) AS n, round(greatest(0, (1 - product(1 - l_discount * 10) - {PRIOR}) / (1 - {PRIOR})), 9) AS combined FROM lineitem GROUP BY 1""")
def _(spark, d):
    lines = table(spark, d, "lineitem").select("l_partkey", F.least(F.lit(1.0), F.col("l_discount") * 10).alias("p"))
    return rounded(evidence.combine_rows(lines, ["l_partkey"], "p", PRIOR), 9, "combined")


@check("evidence_rank_score", """
SELECT p_partkey, p_brand, p_size, round((max(p_size) OVER w - p_size) * 100.0::DOUBLE / nullif(max(p_size) OVER w - min(p_size) OVER w, 0), 6) AS score FROM part WINDOW w AS (PARTITION BY p_brand)""")
def _(spark, d):
    return rounded(evidence.rank_score(table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), "p_size", ["p_brand"]), 6, "score")


# ---- survival --------------------------------------------------------------

LIVES_SQL = "v AS (SELECT l_linestatus, date_diff('day', DATE '1992-01-01', l_shipdate::DATE) AS t, l_returnflag = 'R' AS e FROM lineitem)"


def lives(spark, d):
    return table(spark, d, "lineitem").select("l_linestatus", "l_returnflag", F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).alias("t"), (F.col("l_returnflag") == "R").alias("e"))


@check("survival_curve", f"""
WITH {LIVES_SQL}, c AS (SELECT l_linestatus, t, count(*) AS n, count(*) FILTER (e) AS d FROM v GROUP BY 1, 2),
r AS (SELECT *, sum(n) OVER (PARTITION BY l_linestatus ORDER BY t DESC)::BIGINT AS at_risk FROM c),
s AS (SELECT l_linestatus, t, at_risk, d, CASE WHEN d < at_risk THEN ln(1 - d / at_risk) ELSE 0 END AS l, CASE WHEN d < at_risk THEN d / (at_risk * (at_risk - d)::DOUBLE) ELSE 0 END AS g,
  CASE WHEN d = at_risk THEN 1 ELSE 0 END AS z FROM r WHERE d > 0),
k AS (SELECT *, CASE WHEN sum(z) OVER w > 0 THEN 0 ELSE exp(sum(l) OVER w) END AS survival, sqrt(sum(g) OVER w) AS root FROM s WINDOW w AS (PARTITION BY l_linestatus ORDER BY t))
SELECT l_linestatus, t::DOUBLE AS time, at_risk, d AS events, round(survival, 6) + 0.0 AS survival, round(survival * root, 6) + 0.0 AS std_error FROM k""")
def _(spark, d):
    return rounded(survival.kaplan_meier(lives(spark, d), "t", F.col("e"), ["l_linestatus"]), 6, "survival", "std_error")


@check("survival_log_rank", """
WITH v AS (SELECT date_diff('day', DATE '1992-01-01', l_shipdate::DATE) AS t, l_quantity > 25 AS e, l_returnflag = 'A' AS f FROM lineitem WHERE l_returnflag IN ('A', 'R')),
c AS (SELECT t, count(*) AS n, count(*) FILTER (e) AS d, count(*) FILTER (f) AS n1, count(*) FILTER (e AND f) AS d1 FROM v GROUP BY 1),
r AS (SELECT *, sum(n) OVER (ORDER BY t DESC)::DOUBLE AS r, sum(n1) OVER (ORDER BY t DESC)::DOUBLE AS r1 FROM c),
s AS (SELECT sum(d1)::BIGINT AS observed, sum(d * r1 / r) AS expected, sum(CASE WHEN r > 1 THEN d * (r1 / r) * (1 - r1 / r) * (r - d) / (r - 1) ELSE 0 END) AS variance FROM r WHERE d > 0)
SELECT observed, round(expected, 4) AS expected, round(variance, 4) AS variance, round((observed - expected) ** 2 / variance, 5) AS chi2,
  round(1 - (SELECT sum(exp(-0.5 * pow((k + 0.5) / 20000 * abs(observed - expected) / sqrt(variance), 2))) * abs(observed - expected) / sqrt(variance) / 20000 * sqrt(2 / pi()) FROM range(20000) q(k)), 5) + 0.0 AS p FROM s""")
def _(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).alias("t"), (F.col("l_quantity") > 25).alias("e"))
    return rounded(rounded(survival.log_rank(rows, "t", F.col("e"), "l_returnflag", "A", "R"), 4, "expected", "variance"), 5, "chi2", "p")
