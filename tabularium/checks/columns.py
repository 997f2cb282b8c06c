"""Queries for projection, casting, cleaning, filters and scalar functions (P, F and X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.checks import shapes
from tabularium.checks.registry import check, table
from tabularium.functions import casts, fallback, names, text
from tabularium.operators import aggregate, indexing, lookup
from tabularium.plans.molecules import MOLAR_UNITS

# ---- projection and renaming ----------------------------------------------


@check("p1_fixed_order", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@check("p2_first_columns", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _(spark, d):
    df = table(spark, d, "customer")
    return df.select(df.columns[:3])


@check("p3_keep_list", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, CAST(NULL AS VARCHAR) AS sub_class FROM events""")
def _(spark, d):
    df = table(spark, d, "events")
    return df.select("event_id", F.from_json("props", "k string, sub_class string").alias("r")).select("event_id", "r.*")


@check("p4_rename_map", "SELECT s_suppkey AS protein_a, s_name AS protein_b FROM supplier")
def _(spark, d):
    return names.rename(table(spark, d, "supplier").select("s_suppkey", "s_name"),
                        {"s_suppkey": "protein_a", "s_name": "protein_b", "absent": "x"})


@check("p5_rename_by_position", "SELECT n_nationkey AS \"idA\", n_name AS \"idB\", n_regionkey FROM nation")
def _(spark, d):
    return names.rename_by_position(table(spark, d, "nation"), ["idA", "idB"])


@check("p6_normalise_names", """
SELECT p_partkey AS part_key, p_name AS gene_names, p_brand AS entry_name, p_size AS length FROM part""")
def _(spark, d):
    raw = table(spark, d, "part").select(
        F.col("p_partkey").alias("partKey"), F.col("p_name").alias("Gene Names"), F.col("p_brand").alias(" Entry - Name "),
        F.col("p_size").alias("LENGTH"))
    camel = names.normalise_names(raw.select("partKey"), "snake").columns
    spaced = names.normalise_names(raw.select("Gene Names"), "spaced").columns
    runs = names.normalise_names(raw.select(" Entry - Name "), "runs").columns
    lower = names.normalise_names(raw.select("LENGTH"), "lower").columns
    return raw.toDF(*camel, *spaced, *runs, *lower)


# ---- casts and dates -------------------------------------------------------

def dirty_size():
    """Part sizes as text: 13 reads ``n/a``, 14 is blank, 15 has outer blanks."""
    size = F.col("p_size")
    return F.when(size == 13, "n/a").when(size == 14, "").when(size == 15, " 15 ").otherwise(size.cast("string"))


DIRTY_SIZE_SQL = "CASE p_size WHEN 13 THEN 'n/a' WHEN 14 THEN '' WHEN 15 THEN ' 15 ' ELSE p_size::VARCHAR END"


@check("p7_safe_cast", f"SELECT p_partkey, TRY_CAST(trim({DIRTY_SIZE_SQL}) AS INTEGER) AS size FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", casts.safe(dirty_size(), "int").alias("size"))


@check("p8_strict_cast", "SELECT p_partkey, p_size::SMALLINT AS size, p_retailprice AS price FROM part")
def _(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", casts.strict(F.col("p_size").cast("string"), "smallint").alias("size"),
        casts.strict(F.col("p_retailprice").cast("string"), "double").alias("price"))


@check("p9_cast_present", """
SELECT o_orderkey, o_custkey::VARCHAR AS o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""")
def _(spark, d):
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
    return casts.cast_present(raw, {"o_orderkey": "bigint", "o_orderdate": "date", "gone": "int"})


@check("p10_blank_then_cast", """
SELECT p_partkey, CASE WHEN p_size = 14 THEN NULL ELSE p_size END AS charge FROM part""")
def _(spark, d):
    raw = F.when(F.col("p_size") == 14, "").otherwise(F.col("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", casts.strict(casts.blank_to_null(raw), "int").alias("charge"))


@check("p11_blank_text", "SELECT doc_id, i, nullif(trim(line, ' '), '') AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10)))))::INTEGER AS i FROM documents)")
def _(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return lines.select("doc_id", "i", casts.trimmed("line").alias("line"))


@check("p12_safe_date", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderdate::DATE END AS day FROM orders""")
def _(spark, d):
    raw = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, d, "orders").select("o_orderkey", casts.safe_date(raw).alias("day"))


@check("p13_date_prefix", "SELECT event_id, ts::DATE AS day FROM events")
def _(spark, d):
    raw = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, d, "events").select("event_id", casts.safe_date(casts.date_prefix(raw)).alias("day"))


@check("p14_offset_timestamp", "SELECT event_id, ts - INTERVAL 2 HOUR AS created FROM events")
def _(spark, d):
    raw = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("1+02:00"))
    return table(spark, d, "events").select("event_id", casts.utc_timestamp(raw).alias("created"))


@check("p15_yes_no", "SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus = 'F' AS is_final FROM lineitem")
def _(spark, d):
    flag = F.when(F.col("l_linestatus") == "F", "Y").otherwise("N")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", casts.yes_no(flag).alias("is_final"))


@check("p16_truthy_number", "SELECT doc_id, coalesce(toxic, 0) <> 0 AS is_toxic FROM labels")
def _(spark, d):
    return table(spark, d, "labels").select("doc_id", casts.truthy_number("toxic").alias("is_toxic"))


@check("p17_presence", "SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda s: trim(s, ' ') <> '')) > 1 AS multi_line FROM documents")
def _(spark, d):
    from tabularium.functions.nested import has_items
    rest = F.slice(shapes.paragraphs(F.col("text")), 2, 1_000_000_000)
    return table(spark, d, "documents").select("doc_id", has_items(rest).alias("multi_line"))


@check("p18_rank_case", """
SELECT p_partkey, CASE WHEN p_size > 40 THEN 'subspecies' WHEN p_size > 10 THEN 'species' ELSE 'genus' END AS rank FROM part""")
def _(spark, d):
    df = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_name")).alias("sp_epithet"),
                                        F.when(F.col("p_size") > 40, F.col("p_brand")).alias("subsp_epithet"))
    rank = F.when(F.col("subsp_epithet").isNotNull(), "subspecies").when(F.col("sp_epithet").isNotNull(), "species").otherwise("genus")
    return df.select("p_partkey", rank.alias("rank"))


@check("p19_interval_length", """
SELECT p_partkey, p_partkey * 10 + p_size - p_partkey + 1 AS length, round((p_partkey * 10 + p_size - p_partkey + 1) / 1000, 1) AS span_kb FROM part""")
def _(spark, d):
    start, stop = F.col("p_partkey"), F.col("p_partkey") * 10 + F.col("p_size")
    length = text.span_length(start, stop)
    return table(spark, d, "part").select("p_partkey", length.alias("length"), text.scaled(length, 1000, 1).alias("span_kb"))


@check("p20_first_truthy", """
SELECT p_partkey, CASE WHEN p_type = 'STANDARD' THEN p_brand ELSE p_name END AS title,
       CASE WHEN p_size <= 10 THEN p_size * 2 ELSE p_size END AS n FROM part""")
def _(spark, d):
    blank = F.when(F.col("p_type") == "STANDARD", "").otherwise(F.col("p_name"))
    zero = F.when(F.col("p_size") <= 10, 0).otherwise(F.col("p_size"))
    return table(spark, d, "part").select(
        "p_partkey", fallback.first_truthy(blank, F.col("p_brand")).alias("title"),
        fallback.first_truthy(zero, F.col("p_size") * 2, kind="number").alias("n"))


@check("p21_first_present", "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name ELSE '' END AS title FROM part")
def _(spark, d):
    given = F.when(F.col("p_size") > 25, F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", fallback.first_present(given, F.lit("")).alias("title"))


@check("p22_constants", "SELECT s_suppkey, 'passive' AS mode, CAST(NULL AS VARCHAR) AS imaging_method FROM supplier")
def _(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", F.lit("passive").alias("mode"),
                                              casts.typed_null("string").alias("imaging_method"))


# Names of the order states.
ORDER_STATES = {"O": "open", "F": "finished"}


@check("p23_label_by_dictionary", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' ELSE 'unknown' END AS state FROM orders""")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", lookup.label_by(F.col("o_orderstatus"), ORDER_STATES, F.lit("unknown")).alias("state"))


@check("p24_scaled_measure", "SELECT o_orderkey, round(o_totalprice::DECIMAL(18, 2) * 0.001::DECIMAL(4, 3), 3)::DOUBLE AS total_k FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.scaled(F.col("o_totalprice"), 1000.0, 3).alias("total_k"))


@check("p25_extension", """
SELECT page_id, coalesce(nullif(regexp_extract(lower(split_part(split_part(url, '?', 1), '#', 1)), '^.+(\\.[^.]+)$', 1), ''), '(none)') AS extension FROM pages""")
def _(spark, d):
    path = F.substring_index(F.substring_index("url", "?", 1), "#", 1)
    return table(spark, d, "pages").select("page_id", text.extension(path).alias("extension"))


@check("p26_drop_column", "SELECT r_regionkey FROM region")
def _(spark, d):
    return table(spark, d, "region").drop("r_name", "absent")


@check("p27_category_codes", """
SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS code FROM (SELECT DISTINCT p_brand FROM part)""")
def _(spark, d):
    return indexing.domain_table(table(spark, d, "part"), "p_brand")


@check("p28_narrow_range", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey BETWEEN 0 AND 65535 AS fits, l_partkey::INTEGER AS narrow FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", casts.in_range("l_partkey", 0, 65535).alias("fits"),
        F.col("l_partkey").try_cast("int").alias("narrow"))


# ---- filters ---------------------------------------------------------------


@check("f1_threshold_report", """
SELECT count(*) AS n_total, count(*) FILTER (WHERE l_quantity >= 40) AS n_kept, count(*) FILTER (WHERE l_quantity < 40) AS n_removed,
       round(count(*) FILTER (WHERE l_quantity >= 40) / count(*), 6) AS fraction,
       min(l_quantity) FILTER (WHERE l_quantity >= 40) AS min_kept, max(l_quantity) FILTER (WHERE l_quantity >= 40) AS max_kept FROM lineitem""")
def _(spark, d):
    return aggregate.threshold_report(table(spark, d, "lineitem"), "l_quantity", 40)


@check("f2_equality_filter", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'")
def _(spark, d):
    return table(spark, d, "events").filter(F.col("event_type") == "purchase").select("event_id", "user_id")


@check("f3_null_filter", """
SELECT d.doc_id, l.quality, l.quality IS NULL AS unlabelled FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL OR l.toxic IS NOT NULL""")
def _(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return (joined.filter(F.col("quality").isNull() | F.col("toxic").isNotNull())
                  .select("doc_id", "quality", F.col("quality").isNull().alias("unlabelled")))


@check("f4_both_ends_member", f"""
WITH {shapes.GEO_EDGES_SQL},
keys AS (SELECT child_id AS id FROM edges WHERE relation = 'is_a' AND child_id LIKE 'N%' OR child_id LIKE 'R%')
SELECT DISTINCT child_id, parent_id FROM edges WHERE child_id IN (SELECT id FROM keys) AND parent_id IN (SELECT id FROM keys) AND relation = 'is_a'""")
def _(spark, d):
    edges = shapes.geo_edges(spark, d)
    keys = edges.filter(F.col("child_id").startswith("N") | F.col("child_id").startswith("R")).select(F.col("child_id").alias("id"))
    kept = lookup.both_in(edges.filter("relation = 'is_a'"), keys, "id", "child_id", "parent_id")
    return kept.select("child_id", "parent_id").distinct()


@check("f5_prefix_pair", "SELECT page_id, url LIKE 'https://%' AND html LIKE '<!DOCTYPE html><html lang=\"en\"%' AS both_hold FROM pages")
def _(spark, d):
    both = F.col("url").startswith("https://") & F.col("html").startswith('<!DOCTYPE html><html lang="en"')
    return table(spark, d, "pages").select("page_id", both.alias("both_hold"))


@check("f6_comment_blank_lines", """
SELECT doc_id, i, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10)))))::INTEGER AS i FROM documents)
WHERE length(trim(line, ' ')) > 0 AND NOT starts_with(line, 'The')""")
def _(spark, d):
    from tabularium.sources.delimited import content_lines
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return content_lines(lines, "line", "The")


@check("f7_positive_rates", """
SELECT 'quality' AS "column", count(*) FILTER (WHERE quality IS NULL) AS nulls, round(count(*) FILTER (WHERE quality IS NULL) * 100.0 / count(*), 1) AS null_pct
FROM documents LEFT JOIN labels USING (doc_id) HAVING nulls > 0
UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) AS n, round(count(*) FILTER (WHERE toxic IS NULL) * 100.0 / count(*), 1)
FROM documents LEFT JOIN labels USING (doc_id) HAVING n > 0""")
def _(spark, d):
    from tabularium.operators.profile import null_rates
    joined = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return null_rates(joined, only_with_nulls=True)


@check("f8_skip_malformed", """
SELECT p_partkey, p_partkey * 1000 + p_size AS size_bytes FROM part WHERE p_size <> 13""")
def _(spark, d):
    lines = shapes.listing_lines(spark, d)
    return lines.filter(F.size(F.split(F.trim("line"), "\\s+")) >= 9).select(
        "p_partkey", F.get(F.split("line", "\\s+"), F.lit(4)).try_cast("bigint").alias("size_bytes"))


@check("f9_source_predicate", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R' AND l_discount BETWEEN 0.05 AND 0.07""")
def _(spark, d):
    return (table(spark, d, "lineitem")
            .filter((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_returnflag") == "R")
                    & F.col("l_discount").between(0.05, 0.07))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"))


# ---- scalar functions ------------------------------------------------------


@check("x1_after_first", """
SELECT page_id, CASE WHEN contains(url, ':') THEN substr(url, instr(url, ':') + 1) ELSE url END AS rest,
       CASE WHEN contains(url, '#') THEN substr(url, instr(url, '#') + 1) ELSE url END AS fragment FROM pages""")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", text.after_first(F.col("url"), ":").alias("rest"),
                                           text.after_first(F.col("url"), "#").alias("fragment"))


@check("x2_split_once", "SELECT p_partkey, split_part(p_brand, '#', 1) AS base_id, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS version FROM part")
def _(spark, d):
    parts = table(spark, d, "part").select("p_partkey", text.split_once(F.col("p_brand"), "#", "base_id", "version").alias("s")).select("p_partkey", "s.*")
    return parts.withColumn("version", F.col("version").try_cast("int"))


@check("x3_dotted_levels", """
SELECT p_partkey, p_size AS class, CASE WHEN p_size > 10 THEN p_size * 2 ELSE 0 END AS architecture,
       CASE WHEN p_size > 40 THEN NULL ELSE 0 END::INTEGER AS topology, 0 AS homologous_superfamily FROM part""")
def _(spark, d):
    size = F.col("p_size")
    code = F.concat_ws(".", size.cast("string"), F.when(size > 10, (size * 2).cast("string")), F.when(size > 40, F.lit("x")))
    return table(spark, d, "part").select(
        "p_partkey", *text.dotted_levels(code, ["class", "architecture", "topology", "homologous_superfamily"]))


@check("x4_before_first", "SELECT s_suppkey, split_part(s_name, '#', 1) AS prefix FROM supplier")
def _(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", text.before_first(F.col("s_name"), "#").alias("prefix"))


@check("x5_equation_left", """
WITH e AS (SELECT p_partkey, p_name || ' + ' || p_type || CASE WHEN p_size > 25 THEN ' + ' || p_name ELSE '' END AS l FROM part)
SELECT p_partkey, unnest(list_distinct(list_transform(string_split(l, ' + '), lambda s: trim(s)))) AS participant FROM e""")
def _(spark, d):
    equation = F.concat(F.col("p_name"), F.lit(" + "), F.col("p_type"),
                        F.when(F.col("p_size") > 25, F.concat(F.lit(" + "), F.col("p_name"))).otherwise(""), F.lit(" = "), F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", F.explode(text.equation_participants(equation)).alias("participant"))


@check("x6_regex_group", r"""
SELECT page_id, nullif(regexp_extract(url, '^https?://([^/]+)', 1), '') AS host, nullif(regexp_extract(url, 'page=([0-9]+)', 1), '') AS page_no FROM pages""")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", text.extract(F.col("url"), "^https?://([^/]+)").alias("host"),
                                           text.extract(F.col("url"), "page=([0-9]+)").alias("page_no"))


@check("x7_match_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS km_value, 'mM' AS km_unit, 'flag ' || l_returnflag AS substrate FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_tax, 'µM', 'unknown' FROM lineitem""")
def _(spark, d):
    note = F.concat(F.lit("Km="), F.col("l_quantity").cast("string"), F.lit(" mM for flag "), F.col("l_returnflag"),
                    F.lit("; then KM = "), F.col("l_tax").cast("string"), F.lit(" µM; Km=1.2.3 mM; Vmax=4"))
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", note.alias("note"))
    rows = text.match_rows(df, F.col("note"), text.stated_quantity("km", MOLAR_UNITS, of="for"), {"km_value": 1, "km_unit": 2, "substrate": 3}, {"substrate": "unknown"})
    return rows.withColumn("km_value", casts.safe("km_value", "double")).filter("km_value is not null").drop("note")


@check("x8_accession_path", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE 'S-BIAD/' || right('00' || c_custkey, 3) || '/S-BIAD' || c_custkey || '/Files' END AS path FROM customer""")
def _(spark, d):
    acc = F.concat(F.when(F.col("c_acctbal") < 0, "X").otherwise("S-BIAD"), F.col("c_custkey").cast("string"))
    return table(spark, d, "customer").select("c_custkey", text.accession_path(acc).alias("path"))


@check("x9_next_link", "SELECT page_id, CASE WHEN url LIKE 'https%' THEN url END AS next_url FROM pages")
def _(spark, d):
    header = F.concat(F.lit("<"), F.col("url"), F.lit('>; rel="'), F.when(F.col("url").startswith("https"), "next").otherwise("prev"), F.lit('"'))
    return table(spark, d, "pages").select("page_id", text.next_link(header).alias("next_url"))


@check("x10_fixed_parts", """
SELECT c_custkey, lower(substr(c_name, 1, 4)) AS pdb_id, upper(substr(c_name, 5, 1)) AS chain_id, CASE WHEN length(c_mktsegment) >= 9 THEN substr(c_mktsegment, 9, 1) END AS ninth FROM customer""")
def _(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", F.lower(text.fixed_part(F.col("c_name"), 1, 4)).alias("pdb_id"),
        F.upper(text.fixed_part(F.col("c_name"), 5, 1)).alias("chain_id"), text.fixed_part(F.col("c_mktsegment"), 9, 1).alias("ninth"))


@check("x12_joined_name", """
SELECT p_partkey, CASE WHEN p_size > 40 AND p_type = 'SMALL' THEN NULL WHEN p_size > 40 THEN p_name WHEN p_type = 'SMALL' THEN lower(p_brand) ELSE p_name || ' ' || lower(p_brand) END AS name FROM part""")
def _(spark, d):
    a = F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_name"))
    b = F.when(F.col("p_size") <= 40, F.lower("p_brand"))
    return table(spark, d, "part").select("p_partkey", text.joined_name(a, b).alias("name"))


@check("x13_preview", "SELECT doc_id, CASE WHEN length(text) > 80 THEN text[1:80] || '…' ELSE text END AS preview FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", text.preview(F.col("text"), 80).alias("preview"))


@check("x14_relation_parts", "SELECT n_nationkey, 'part_of' AS relation, 'R' || n_regionkey AS target FROM nation")
def _(spark, d):
    relation, target = text.relation_parts(F.concat(F.lit("part_of R"), F.col("n_regionkey").cast("string"), F.lit(" ! some label")))
    return table(spark, d, "nation").select("n_nationkey", relation.alias("relation"), target.alias("target"))


@check("x15_contrast_stretch", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
       round(least(greatest((l_extendedprice - lo) / greatest(hi - lo, 1e-9), 0), 1), 9) AS stretched FROM lineitem JOIN q USING (l_returnflag)""")
def _(spark, d):
    from tabularium.operators.quantiles import stretch
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice")
    return stretch(df, "l_extendedprice", ["l_returnflag"], 0.01, 0.99, "stretched").withColumn("stretched", F.round("stretched", 9)).drop("l_extendedprice")


@check("x16_lineage", "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand ELSE p_type || ';;' || p_name END AS lineage FROM part")
def _(spark, d):
    given = F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("")
    return table(spark, d, "part").select("p_partkey", text.lineage(given, [F.col("p_type"), F.lit(None).cast("string"), F.col("p_name")]).alias("lineage"))


@check("x17_safe_names", "SELECT p_partkey, p_type AS class_, p_name AS superkingdom FROM part")
def _(spark, d):
    from tabularium.functions.nested import TAXON_LEVELS
    raw = table(spark, d, "part").select("p_partkey", F.col("p_type").alias("class"), F.col("p_name").alias("super kingdom"))
    return names.rename(raw, TAXON_LEVELS)
