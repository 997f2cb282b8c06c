"""Queries for joins, aggregates, ordering, sets, hierarchies and quality (J, A, O, U, G and Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.checks import shapes
from tabularium.checks.registry import check, table
from tabularium.checks.sources import landed_manifest, some_orders
from tabularium.functions import casts, nested, text
from tabularium.operators import (aggregate, catalogue, correlate, hierarchy, histogram, lookup, profile, quantiles, sinks,
                                  topk, validate)
from tabularium.plans.base import JsonTable
from tabularium.session import fresh_path
from tabularium.sources import landed

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# ---- joins -----------------------------------------------------------------


@check("j1_lookup_join", "SELECT c_custkey, c_name, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def _(spark, d):
    geo = lookup.lookup_join(table(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), table(spark, d, "region"), "r_regionkey")
    customer = table(spark, d, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return lookup.lookup_join(customer, geo, "n_nationkey").select("c_custkey", "c_name", "n_name", "r_name")


@check("j2_semi_both_ends", f"""
WITH {shapes.GEO_EDGES_SQL}
SELECT child_id, parent_id, relation FROM edges WHERE child_id IN (SELECT parent_id FROM edges) AND parent_id IN (SELECT parent_id FROM edges)""")
def _(spark, d):
    edges = shapes.geo_edges(spark, d)
    return lookup.both_in(edges, edges.select(F.col("parent_id").alias("id")), "id", "child_id", "parent_id")


@check("j3_anti_manifest", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, d):
    return lookup.not_yet(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), ["doc_id"])


@check("j4_primary_else_fallback", """
SELECT l.doc_id, l.quality::VARCHAR AS value, 'label' AS source FROM labels l
UNION ALL SELECT doc_id, lang, 'document' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, d):
    primary = table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("value"))
    fallback = table(spark, d, "documents").select("doc_id", F.col("lang").alias("value"))
    return lookup.primary_else(primary, fallback, "doc_id", ("label", "document"))


# ---- aggregates ------------------------------------------------------------


@check("a1_group_count", "SELECT event_type, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1")
def _(spark, d):
    return aggregate.group_count(table(spark, d, "events"), "event_type")


@check("a2_group_total", "SELECT l_returnflag AS type, count(*) AS count, round(sum(l_quantity) / 1000, 1) AS total FROM lineitem GROUP BY 1")
def _(spark, d):
    df = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("type"), "l_quantity")
    return aggregate.group_total(df, "type", "l_quantity", 1000.0, 1)


@check("a3_filtered_top", "SELECT o_custkey, count(*) AS n_species FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(spark, d):
    counts = table(spark, d, "orders").filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(F.count("*").alias("n_species"))
    return topk.top(counts, 10, F.col("n_species").desc(), F.col("o_custkey"))


def labelled(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")


@check("a4_null_counts", """
SELECT count(*) FILTER (WHERE doc_id IS NULL) AS doc_id, count(*) FILTER (WHERE lang IS NULL) AS lang, count(*) FILTER (WHERE quality IS NULL) AS quality,
       count(*) FILTER (WHERE toxic IS NULL) AS toxic FROM documents LEFT JOIN labels USING (doc_id)""")
def _(spark, d):
    return profile.null_counts(labelled(spark, d))


@check("a5_null_rates", """
WITH j AS (SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
u AS (SELECT 'doc_id' AS "column", count(*) FILTER (WHERE doc_id IS NULL) AS nulls, count(*) AS n FROM j UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL), count(*) FROM j
      UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL), count(*) FROM j UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL), count(*) FROM j)
SELECT "column", nulls, round(nulls * 100.0 / n, 1) AS null_pct FROM u""")
def _(spark, d):
    return profile.null_rates(labelled(spark, d))


DESCRIBE_SQL = " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75,
  round(max({c}), 6) AS max FROM lineitem""" for c in MEASURES)


@check("a6_describe", DESCRIBE_SQL)
def _(spark, d):
    return profile.describe(table(spark, d, "lineitem"), MEASURES)


@check("a7_scalar_stats", """
SELECT min(value) AS lo, max(value) AS hi, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_pop(value), 6) AS std, round(sum(value), 2) AS total FROM events""")
def _(spark, d):
    df = table(spark, d, "events")
    moments = df.agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.round(F.avg("value"), 6).alias("mean"),
                     F.round(F.stddev_pop("value"), 6).alias("std"), F.round(F.sum(F.col("value").cast("decimal(20,2)")), 2).cast("double").alias("total"))
    middle = quantiles.quantile_columns(df, "value", {"median": 0.5}).select("median")
    return moments.select("*", F.round(middle.scalar(), 6).alias("median"))


@check("a8_distinct_count", """
SELECT source, count(DISTINCT quality) AS n_values, count(DISTINCT quality) + max((quality IS NULL)::BIGINT) AS n_unique FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def _(spark, d):
    df = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left")
    return df.groupBy("source").agg(aggregate.distinct_count("quality").alias("n_values"), aggregate.distinct_count("quality", count_null=True).alias("n_unique"))


@check("a9_distinct_values", "SELECT DISTINCT p_type, p_brand FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_type", "p_brand").distinct()


@check("a10_true_share", "SELECT count(*) FILTER (WHERE l_linestatus = 'F') AS n_true, round(count(*) FILTER (WHERE l_linestatus = 'F') * 100.0 / count(*), 1) AS pct FROM lineitem")
def _(spark, d):
    df = table(spark, d, "lineitem").select((F.col("l_linestatus") == "F").alias("flag"))
    return df.agg(*aggregate.true_share("flag", "n_true", "pct"))


@check("a11_column_means", " UNION ALL ".join(f"SELECT '{c}' AS channel, round(avg({c}), 6) AS mean_score FROM lineitem" for c in MEASURES))
def _(spark, d):
    return aggregate.column_means(table(spark, d, "lineitem"), MEASURES, "channel", "mean_score").withColumn("mean_score", F.round("mean_score", 6))


@check("a12_correlation", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in MEASURES for b in MEASURES))
def _(spark, d):
    return correlate.corr_matrix(table(spark, d, "lineitem"), MEASURES)


@check("a13_lower_triangle", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for i, a in enumerate(MEASURES) for b in MEASURES[:i + 1]))
def _(spark, d):
    return correlate.corr_matrix(table(spark, d, "lineitem"), MEASURES, lower_only=True)


@check("a14_percentiles", """
SELECT label, round(quantile_cont(v, 0.01), 9) AS p1, round(quantile_cont(v, 0.99), 9) AS p99 FROM (SELECT label, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY 1""")
def _(spark, d):
    pixels = table(spark, d, "embeddings").select("label", F.explode(F.col("embedding").cast("array<double>")).alias("v"))
    q = quantiles.quantile_columns(pixels, "v", {"p1": 0.01, "p99": 0.99}, by=["label"])
    return q.select("label", F.round("p1", 9).alias("p1"), F.round("p99", 9).alias("p99"))


@check("a14_infinite_values", """
WITH v AS (SELECT l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY CASE WHEN l_quantity > 25 THEN 'infinity'::DOUBLE ELSE l_quantity END) - 1 AS k, count(*) OVER (PARTITION BY l_returnflag) - 1 AS n,
  CASE WHEN l_quantity > 25 THEN 'infinity'::DOUBLE ELSE l_quantity END AS v FROM lineitem)
SELECT l_returnflag, max(v) FILTER (k = floor(n * 0.25)) + CASE WHEN max(v) FILTER (k = floor(n * 0.25)) = max(v) FILTER (k = ceil(n * 0.25)) THEN 0 ELSE
  (max(v) FILTER (k = ceil(n * 0.25)) - max(v) FILTER (k = floor(n * 0.25))) * (any_value(n) * 0.25 - floor(any_value(n) * 0.25)) END AS lower, max(v) FILTER (k = floor(n * 0.9)) AS upper FROM v GROUP BY 1""")
def _(spark, d):
    v = F.when(F.col("l_quantity") > 25, F.lit(float("inf"))).otherwise(F.col("l_quantity"))
    return quantiles.quantile_columns(table(spark, d, "lineitem").select("l_returnflag", v.alias("v")), "v", {"lower": 0.25, "upper": 0.9}, by=["l_returnflag"])


@check("a15_histogram", """
WITH r AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 100 AS w FROM lineitem),
c AS (SELECT least(floor((l_extendedprice - lo) / w), 99)::INTEGER AS bin, count(*) AS n FROM lineitem, r GROUP BY 1)
SELECT b::INTEGER AS bin, round(lo + b * w, 6) AS lower, round(lo + (b + 1) * w, 6) AS upper, coalesce(n, 0) AS n_rows FROM range(100) t(b) CROSS JOIN r LEFT JOIN c ON c.bin = b""")
def _(spark, d):
    return histogram.histogram(table(spark, d, "lineitem"), "l_extendedprice", 100).withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


THRESHOLDS = {"medium": 100_000.0, "high": 200_000.0, "very high": 400_000.0}


@check("a16_threshold_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS label, {t}::DOUBLE AS threshold, count(*) FILTER (WHERE o_totalprice >= {t}) AS n_rows FROM orders" for n, t in THRESHOLDS.items()))
def _(spark, d):
    return aggregate.threshold_counts(table(spark, d, "orders"), "o_totalprice", THRESHOLDS)


@check("a17_entity_rollup", """
WITH k AS (SELECT DISTINCT l_partkey FROM lineitem)
SELECT l_partkey, (SELECT count(DISTINCT l_suppkey) FROM lineitem x WHERE x.l_partkey = k.l_partkey) AS n_suppliers,
  (SELECT count(DISTINCT l_shipdate) FROM lineitem x WHERE x.l_partkey = k.l_partkey AND l_returnflag = 'R') AS n_return_days,
  (SELECT count(DISTINCT l_orderkey) FROM lineitem x WHERE x.l_partkey = k.l_partkey AND l_linestatus = 'F') AS n_final_orders FROM k""")
def _(spark, d):
    lines = table(spark, d, "lineitem")
    return aggregate.entity_rollup(lines, "l_partkey", {
        "n_suppliers": F.col("l_suppkey"), "n_return_days": F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")),
        "n_final_orders": F.when(F.col("l_linestatus") == "F", F.array("l_orderkey", "l_orderkey"))})


@check("a17_signed_zeros", """
SELECT l_partkey, count(DISTINCT CASE WHEN l_tax = 0 THEN 0 ELSE l_tax END) AS n_taxes, count(DISTINCT l_linestatus) AS n_states FROM lineitem GROUP BY 1""")
def _(spark, d):
    signed = F.when((F.col("l_tax") == 0) & (F.col("l_linenumber") % 2 == 0), F.lit(-0.0)).otherwise(F.col("l_tax"))
    return aggregate.entity_rollup(table(spark, d, "lineitem"), "l_partkey", {"n_taxes": signed, "n_states": F.array("l_linestatus")})


@check("a18_source_counts", "SELECT CASE WHEN grouping(source) = 1 THEN 'total' ELSE source END AS source, count(*) AS n_rows FROM documents GROUP BY ROLLUP (source)")
def _(spark, d):
    return aggregate.source_counts(table(spark, d, "documents"), "source")


@check("a19_parse_outcome", "SELECT count(*) AS n_total, count(*) FILTER (WHERE p_size NOT IN (13, 14)) AS n_ok, count(*) FILTER (WHERE p_size IN (13, 14)) AS n_failed FROM part")
def _(spark, d):
    size = nested.kv_get(shapes.part_attributes(), "Number of samples")
    error = F.when(casts.safe(size, "int").isNull(), F.concat(F.lit("not a number: "), size))
    return aggregate.parse_outcome(table(spark, d, "part").select(error.alias("error")), "error")


@check("a20_condition_count", r"SELECT nullif(regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1), '') AS condition, count(*) AS n_images FROM pages GROUP BY 1")
def _(spark, d):
    condition = text.extract(F.col("url"), "^https?://[^/]+/([a-z]+)/")
    return aggregate.group_count(table(spark, d, "pages").select(condition.alias("condition")), "condition", out="n_images")


# ---- ordering --------------------------------------------------------------


@check("o1_sorted", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey")
def _(spark, d):
    return topk.ordered(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", descending=True, ties=["o_orderkey"])


@check("o2_head", "SELECT event_id, user_id, value FROM events ORDER BY event_id LIMIT 10")
def _(spark, d):
    return topk.top(table(spark, d, "events").select("event_id", "user_id", "value"), 10, "event_id")


@check("o3_extreme_row", """
SELECT arg_max(s_name, (s_acctbal, -s_suppkey)) AS s_name, max(s_acctbal) AS s_acctbal FROM supplier""")
def _(spark, d):
    return topk.extreme_row(table(spark, d, "supplier"), "s_acctbal", ["s_name", "s_acctbal"], default={"s_name": "none"}, ties="s_suppkey")


@check("o4_first_keys", "SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 500")
def _(spark, d):
    return topk.top(table(spark, d, "customer").select("c_custkey"), 500, "c_custkey")


@check("o5_one_record", "SELECT n_nationkey, n_name FROM nation WHERE n_name = 'NATION_7'")
def _(spark, d):
    return table(spark, d, "nation").filter(F.col("n_name") == "NATION_7").limit(1).select("n_nationkey", "n_name")


# ---- sets ------------------------------------------------------------------


@check("u1_union_all", "SELECT c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def _(spark, d):
    return (table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"))
            .unionByName(table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))))


@check("u2_set_with_root", f"WITH {shapes.GEO_EDGES_SQL} SELECT child_id AS id FROM edges WHERE relation = 'is_a' UNION SELECT 'ROOT'")
def _(spark, d):
    nodes = shapes.geo_edges(spark, d).filter("relation = 'is_a'").select(F.col("child_id").alias("id"))
    return hierarchy.with_roots(nodes, spark.createDataFrame([("ROOT",)], "id string"))


@check("u3_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey").distinct()


@check("u4_unique_ids", "SELECT DISTINCT l_partkey FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_partkey").dropDuplicates(["l_partkey"])


# ---- hierarchies -----------------------------------------------------------


@check("g1_edge_table", f"WITH {shapes.GEO_EDGES_SQL} SELECT child_id, '' AS child_name, parent_id, relation FROM edges")
def _(spark, d):
    from tabularium.sources import obo
    edges = shapes.geo_edges(spark, d)
    parent = F.when(F.col("relation") == "is_a", F.concat(F.lit("is_a: "), F.col("parent_id"))).otherwise(
        F.concat(F.lit("relationship: "), F.col("relation"), F.lit(" "), F.col("parent_id")))
    stanza = F.concat(F.lit("[Term]\nid: "), F.col("child_id"), F.lit("\n"), parent, F.lit(" ! label"))
    return obo.term_edges(edges.select(stanza.alias("stanza")))


CLOSURE_SQL = f"""
WITH RECURSIVE {shapes.GEO_EDGES_SQL},
down(id) AS (SELECT child_id FROM edges WHERE parent_id = 'ROOT' AND relation = 'is_a'
  UNION SELECT child_id FROM edges JOIN down ON parent_id = id WHERE relation = 'is_a')"""


@check("g2_descendants", CLOSURE_SQL + """
SELECT id, CASE substr(id, 1, 1) WHEN 'R' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS depth FROM down""")
def _(spark, d):
    return hierarchy.descendants(shapes.geo_edges(spark, d), spark.createDataFrame([("ROOT",)], "id string"))


@check("g3_induced_edges", CLOSURE_SQL + """
SELECT child_id, parent_id, relation FROM edges WHERE relation = 'is_a' AND child_id IN (SELECT id FROM down) AND (parent_id IN (SELECT id FROM down) OR parent_id = 'ROOT')""")
def _(spark, d):
    edges = shapes.geo_edges(spark, d)
    root = spark.createDataFrame([("ROOT",)], "id string")
    return hierarchy.induced_edges(edges, hierarchy.with_roots(hierarchy.descendants(edges, root), root))


@check("g4_relation_filter", f"WITH {shapes.GEO_EDGES_SQL} SELECT child_id, parent_id FROM edges WHERE relation = 'has_part'")
def _(spark, d):
    return hierarchy.of_relation(shapes.geo_edges(spark, d), "has_part").select("child_id", "parent_id")


@check("g5_adjacency", f"""
WITH {shapes.GEO_EDGES_SQL}, e AS (SELECT DISTINCT parent_id, child_id FROM edges WHERE relation = 'is_a')
SELECT parent_id, child_id, count(*) OVER (PARTITION BY parent_id) AS n_children FROM e""")
def _(spark, d):
    return hierarchy.adjacency(shapes.geo_edges(spark, d))


@check("g6_edge_file", "SELECT 'R' || n_regionkey AS parent_id, 'N' || n_nationkey AS child_id FROM nation UNION ALL SELECT 'N' || c_nationkey, 'C' || c_custkey FROM customer")
def _(spark, d):
    from tabularium.sources import delimited
    path = fresh_path(spark, "edges")
    nation = table(spark, d, "nation").select(F.concat(F.lit("R"), "n_regionkey", F.lit("\tN"), "n_nationkey").alias("value"))
    nation.union(table(spark, d, "customer").select(F.concat(F.lit("N"), "c_nationkey", F.lit("\tC"), "c_custkey"))).write.text(path)
    return delimited.read_table(spark, path, "parent_id string, child_id string", header=False)


# ---- quality ---------------------------------------------------------------


@check("q1_table_profile", """
SELECT 0 AS position, 'doc_id' AS "column", 'bigint' AS dtype, count(*) AS n_rows, 0::BIGINT AS nulls, 0.0::DOUBLE AS null_pct, min(doc_id)::VARCHAR AS min_text, max(doc_id)::VARCHAR AS max_text FROM documents
UNION ALL SELECT 1, 'lang', 'string', count(*), 0, 0.0, min(lang), max(lang) FROM documents
UNION ALL SELECT 2, 'quality', 'int', count(*), count(*) FILTER (WHERE quality IS NULL), round(count(*) FILTER (WHERE quality IS NULL) * 100.0 / count(*), 1), min(quality)::VARCHAR, max(quality)::VARCHAR FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 3, 'toxic', 'int', count(*), count(*) FILTER (WHERE toxic IS NULL), round(count(*) FILTER (WHERE toxic IS NULL) * 100.0 / count(*), 1), min(toxic)::VARCHAR, max(toxic)::VARCHAR FROM documents LEFT JOIN labels USING (doc_id)""")
def _(spark, d):
    return profile.profile(labelled(spark, d))


@check("q2_failure_capture", """
SELECT p_partkey, CASE WHEN p_size IN (13, 14) THEN NULL ELSE p_size END AS size,
  CASE WHEN p_type = 'STANDARD' THEN 'no title' WHEN p_size IN (13, 14) THEN 'bad size' WHEN p_type = 'SMALL' THEN 'no type' END AS error FROM part""")
def _(spark, d):
    a = F.col("attrs")
    size = casts.safe(nested.kv_get(a, "Number of samples"), "int")
    error = validate.first_error({"no title": casts.blank_to_null(nested.kv_get(a, "Title")).isNull(), "bad size": size.isNull(),
                                  "no type": nested.kv_get(a, "Type").isNull()})
    return table(spark, d, "part").select("p_partkey", shapes.part_attributes().alias("attrs")).select("p_partkey", size.alias("size"), error.alias("error"))


@check("q3_violations", """
SELECT l_orderkey, l_linenumber, l_partkey, 'discount at most 8%' AS rule FROM lineitem WHERE l_discount > 0.08
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'small lines untaxed' FROM lineitem WHERE l_quantity < 3 AND l_tax > 0""")
def _(spark, d):
    return validate.violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], {
        "discount at most 8%": F.col("l_discount") <= 0.08, "small lines untaxed": (F.col("l_quantity") >= 3) | (F.col("l_tax") <= 0)})


@check("q3_matrix_problems", """
SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 'missing bases: T' ELSE 'unequal lengths' END AS problem FROM part WHERE p_type = 'SMALL' OR (p_size = 13 AND length(p_name) <> 2)""")
def _(spark, d):
    from tabularium.checks.nested import motif
    problem = nested.matrix_problem([F.col(b) for b in nested.BASES])
    return motif(spark, d).select("p_partkey", problem.alias("problem")).filter("problem is not null")


@check("q4_key_prefix", "SELECT lang, count(*) AS n_keys, count(*) FILTER (WHERE source NOT LIKE 'src1%') AS n_foreign, bool_and(source LIKE 'src1%') AS valid FROM documents GROUP BY 1")
def _(spark, d):
    return validate.prefix_guard(table(spark, d, "documents"), "source", ["src1"], by=["lang"])


@check("q5_differing_rows", """
SELECT count(*) AS n_left, count(*) AS n_right, 2 * count(*) FILTER (WHERE o_orderstatus = 'P') AS n_differ, true AS same_schema, false AS ok FROM orders""")
def _(spark, d):
    df = some_orders(spark, d)
    changed = df.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")))
    return sinks.same_rows(df, sinks.write_parquet(changed, fresh_path(spark, "differ")))


@check("q6_optional_section", """
SELECT p_partkey, p_brand AS go_id FROM part WHERE p_size > 25""")
def _(spark, d):
    data = F.when(F.col("p_size") > 25, F.array(F.struct(F.col("p_brand").alias("id"))))
    pages = table(spark, d, "part").select("p_partkey", F.to_json(F.struct(data.alias("data"))).alias("page"))
    return landed.unwrap_pages(pages, "page", ["$.data"], keep=["p_partkey"]).select("p_partkey", F.variant_get("item", "$.id", "string").alias("go_id"))


@check("q2_rejected_records", """
SELECT p_partkey, CASE WHEN p_size = 13 THEN 'unreadable' WHEN p_size IN (14, 15) THEN 'wrong shape' WHEN p_size = 16 THEN 'unreadable' ELSE 'E-' || p_partkey END AS outcome FROM part""")
def _(spark, d):
    plan = JsonTable("record", "accession: string", lambda r, _: {"accession": r["accession"]})
    record = F.to_json(F.struct(F.concat(F.lit("E-"), F.col("p_partkey").cast("string")).alias("accession")))
    for size, text in {13: '{"accession":', 14: "[1]", 15: '"text"', 16: None}.items():
        record = F.when(F.col("p_size") == size, F.lit(text)).otherwise(record)
    records = table(spark, d, "part").select("p_partkey", record.alias("record"))
    return plan.from_records(records, keep=["p_partkey"]).union(plan.rejected_records(records, keep=["p_partkey"])).select("p_partkey", F.col("accession").alias("outcome"))


@check("q7_stored_size", "SELECT true AS has_files, count(*) AS n_rows, true AS has_bytes FROM orders")
def _(spark, d):
    path = fresh_path(spark, "size")
    sinks.write_parquet(some_orders(spark, d), path)
    return catalogue.stored_size(spark, path).select((F.col("n_files") > 0).alias("has_files"), "n_rows", (F.col("n_bytes") > 0).alias("has_bytes"))


# ---- flagship --------------------------------------------------------------


@check("flagship_brand_summary", """
SELECT p_brand AS brand, count(*) AS n_records, count(*) FILTER (WHERE p_size NOT IN (13, 14) OR p_size > 45) AS n_sized,
       coalesce(sum(p_size) FILTER (WHERE p_size NOT IN (13, 14)), 0)::BIGINT AS total_size, max(CASE WHEN p_size NOT IN (20, 21) THEN DATE '2020-01-01' + p_size END)::DATE AS last_release
FROM part GROUP BY 1""")
def _(spark, d):
    record = F.parse_json("record")
    attrs = F.try_variant_get(record, "$.attributes", "array<struct<name: string, value: string>>")
    flat = shapes.part_records(spark, d).select(record.alias("_r"), attrs.alias("_a")).select(
        nested.kv_get(F.col("_a"), "Brand", skip_blank=True).alias("brand"),
        casts.safe(F.coalesce(nested.pick(F.col("_r"), "$.numberOfComponents"), nested.kv_get(F.col("_a"), "Number of samples")), "int").alias("size"),
        casts.safe_date(nested.pick(F.col("_r"), "$.releaseDate")).alias("release"))
    return flat.groupBy("brand").agg(F.count("*").alias("n_records"), F.count("size").alias("n_sized"),
                                     aggregate.zero_sum("size").alias("total_size"), F.max("release").alias("last_release"))
