"""Queries for nested records (N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.checks import shapes
from tabularium.checks.registry import check, spread, table
from tabularium.functions import nested, text

LINES = "list_filter(string_split(text, chr(10)), lambda s: trim(s, ' ') <> '')"


def parsed_parts(spark, d):
    """Part records with the JSON text parsed once."""
    return shapes.part_records(spark, d).select("p_partkey", F.parse_json("record").alias("r"))


@check("n1_deep_path", "SELECT p_partkey, p_name AS title, CASE WHEN p_size > 45 THEN p_size END AS n, CAST(NULL AS VARCHAR) AS absent FROM part")
def _(spark, d):
    r = F.col("r")
    return parsed_parts(spark, d).select(
        "p_partkey", nested.pick(r, "$.title").alias("title"), nested.pick(r, "$.numberOfComponents", "int").alias("n"),
        nested.pick(r, "$.title.deeper.still").alias("absent"))


@check("n2_first_item", f"SELECT doc_id, {LINES}[1] AS first_line FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", nested.first_item(shapes.paragraphs(F.col("text"))).alias("first_line"))


@check("n3_scalar_or_list", f"""
SELECT doc_id, CASE WHEN len({LINES}) > 0 THEN {LINES}[1] END AS first_line, CASE WHEN lang = 'en' THEN len({LINES}) ELSE n_chars END::INTEGER AS n,
       CASE WHEN len({LINES}) <> 1 THEN 'list' ELSE 'object' END AS kind FROM documents""")
def _(spark, d):
    lines = F.transform(shapes.paragraphs(F.col("text")), lambda s: F.struct(s.alias("t")))
    body = F.when(F.size(lines) == 1, F.to_json(F.get(lines, F.lit(0)))).otherwise(F.to_json(lines))
    count = F.when(F.col("lang") == "en", F.to_json(lines)).otherwise(F.col("n_chars").cast("string"))
    doc = F.concat(F.lit('{"lines":'), body, F.lit(',"size":'), count, F.lit("}"))
    v = F.col("v")
    return table(spark, d, "documents").select("doc_id", F.parse_json(doc).alias("v")).select(
        "doc_id", nested.item_or_first(v, "$.lines", ".t").alias("first_line"), nested.list_or_count(v, "$.size").alias("n"),
        nested.kind_of(F.try_variant_get(v, "$.lines", "variant")).alias("kind"))


@check("n4_attribute_lookup", """
SELECT p_partkey, CASE WHEN p_type = 'STANDARD' THEN '' ELSE p_name END AS title, p_brand AS brand_first,
       CASE WHEN p_size > 40 THEN 'other' ELSE p_brand END AS brand_last, CASE WHEN p_type <> 'SMALL' THEN p_type END AS type_any_case,
       CAST(NULL AS VARCHAR) AS absent, CASE WHEN p_type <> 'STANDARD' THEN p_name END AS title_filled FROM part""")
def _(spark, d):
    a = shapes.part_attributes()
    return table(spark, d, "part").select(
        "p_partkey", nested.kv_get(a, "Title").alias("title"), nested.kv_get(a, "Brand").alias("brand_first"),
        nested.kv_get(a, "Brand", keep="last").alias("brand_last"), nested.kv_get(a, "TYPE", ignore_case=True).alias("type_any_case"),
        nested.kv_get(a, "Organism").alias("absent"), nested.kv_get(a, "Title", skip_blank=True).alias("title_filled"))


@check("n5_tree_attribute", """
SELECT doc_id, CASE WHEN lang = 'en' THEN source WHEN lang = 'fr' THEN 'line ' || length(text) ELSE lang END AS organism FROM documents""")
def _(spark, d):
    # English: on the root. French: only in the second subsection. Others: in the section, and again deeper.
    def node(attrs, **parts):
        return F.struct(F.array(*attrs).alias("attributes"), *[v.alias(k) for k, v in parts.items()])

    organism = lambda v: F.struct(F.lit("ORGANISM").alias("name"), v.alias("value"))
    none = F.struct(F.lit("Title").alias("name"), F.lit("x").alias("value"))
    deep = organism(F.concat(F.lit("line "), F.length("text").cast("string")))
    subs = F.array(node([none]), node([none, deep]))
    root_attr = F.when(F.col("lang") == "en", organism(F.col("source"))).otherwise(none)
    section_attr = F.when(F.col("lang").isin("en", "fr"), none).otherwise(organism(F.col("lang")))
    tree = F.struct(F.array(none, root_attr).alias("attributes"),
                    node([section_attr], subsections=subs).alias("section"))
    docs = table(spark, d, "documents").select("doc_id", F.parse_json(F.to_json(tree)).alias("tree"))
    return nested.find_attribute(docs, "tree", "Organism", "organism").select("doc_id", "organism")


@check("n6_join_list", f"""
SELECT doc_id, nullif(array_to_string({LINES}, ' | '), '') AS lines, array_to_string(string_split(text, chr(10)), ' | ') AS with_blanks,
       nullif(array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[A-Z][a-z]+'))), ', '), '') AS words FROM documents""")
def _(spark, d):
    t = F.col("text")
    words = F.regexp_extract_all(t, F.lit("[A-Z][a-z]+"), F.lit(0))
    return table(spark, d, "documents").select(
        "doc_id", nested.join_list(F.filter(F.split(t, "\n"), lambda s: F.trim(s) != "")).alias("lines"),
        nested.join_list(F.split(t, "\n"), keep_blank=True).alias("with_blanks"),
        nested.join_list(words, ", ", distinct=True, order=True).alias("words"))


@check("n7_list_length", f"SELECT doc_id, len({LINES})::INTEGER AS n_lines, CASE WHEN lang = 'en' THEN len({LINES}) ELSE 0 END::INTEGER AS n_or_zero FROM documents")
def _(spark, d):
    lines = shapes.paragraphs(F.col("text"))
    return table(spark, d, "documents").select("doc_id", nested.list_size(lines).alias("n_lines"),
                                               nested.list_size(F.when(F.col("lang") == "en", lines)).alias("n_or_zero"))


@check("n8_conditional_count", """
SELECT vec_id, len(list_filter(embedding, lambda x: x > 0))::INTEGER AS n_positive, len(list_filter(embedding, lambda x: NOT x > 0))::INTEGER AS n_other FROM embeddings""")
def _(spark, d):
    e = F.col("embedding")
    return table(spark, d, "embeddings").select("vec_id", nested.count_where(e, lambda x: x > 0).alias("n_positive"),
                                                nested.count_where(e, lambda x: ~(x > 0)).alias("n_other"))


@check("n9_explode_keep_parent", f"""
SELECT doc_id, source, unnest(CASE WHEN len(({LINES})[2:]) = 0 THEN [NULL] ELSE ({LINES})[2:] END) AS line FROM documents""")
def _(spark, d):
    rest = F.slice(shapes.paragraphs(F.col("text")), 2, 1_000_000_000)
    return table(spark, d, "documents").select("doc_id", "source", F.explode_outer(rest).alias("line"))


@check("n10_explode_drop_parent", f"SELECT doc_id, source, unnest(({LINES})[2:]) AS line FROM documents")
def _(spark, d):
    rest = F.slice(shapes.paragraphs(F.col("text")), 2, 1_000_000_000)
    return table(spark, d, "documents").select("doc_id", "source", F.explode(rest).alias("line"))


@check("n11_multi_level_explode", f"""
WITH l AS (SELECT doc_id, unnest({LINES}) AS line, unnest(range(len({LINES})))::INTEGER AS line_no FROM documents WHERE lang = 'en')
SELECT doc_id, line_no, word FROM (SELECT doc_id, line_no, unnest(regexp_extract_all(line, '[A-Z][a-z]+')) AS word FROM l)""")
def _(spark, d):
    comments = F.array(F.struct(F.when(F.col("lang") == "en", "KINETICS").otherwise("OTHER").alias("kind"),
                                shapes.paragraphs(F.col("text")).alias("texts")))
    entries = table(spark, d, "documents").select("doc_id", comments.alias("comments"))
    texts = (entries.select("doc_id", F.inline("comments")).filter(F.col("kind") == "KINETICS")
             .select("doc_id", F.posexplode("texts").alias("line_no", "line")))
    return texts.select("doc_id", "line_no", F.explode(F.regexp_extract_all("line", F.lit("[A-Z][a-z]+"), F.lit(0))).alias("word"))


@check("n12_pivot_known", """
SELECT p_partkey, CASE WHEN p_size > 40 THEN 'other' ELSE p_brand END AS brand, CASE WHEN p_type <> 'SMALL' THEN p_type END AS kind, CAST(NULL AS VARCHAR) AS omim_id FROM part""")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", *nested.pivot_known(
        shapes.part_attributes(), {"Brand": "brand", "Type": "kind", "OMIM": "omim_id"}))


@check("n13_pivot_dynamic", """
SELECT event_id, CASE event_type WHEN 'click' THEN value END AS str_click, CASE event_type WHEN 'error' THEN value END AS str_error,
       CASE event_type WHEN 'purchase' THEN value END AS str_purchase, CASE event_type WHEN 'signup' THEN value END AS str_signup,
       CASE event_type WHEN 'view' THEN value END AS str_view FROM events""")
def _(spark, d):
    attrs = F.array(F.struct(F.col("event_type").alias("id"), F.col("value").alias("alleles")))
    df = table(spark, d, "events").select("event_id", attrs.alias("marker"))
    names = [r["key"] for r in nested.attribute_names(df, "marker", name="id").collect()]
    return nested.pivot_keys(df, ["event_id"], "marker", "str_", names, name="id", value="alleles")


@check("n13_attribute_rows", "SELECT event_id, event_type AS key, value FROM events")
def _(spark, d):
    attrs = F.array(F.struct(F.col("event_type").alias("id"), F.lit(-1.0).alias("alleles")), F.struct(F.col("event_type").alias("id"), F.col("value").alias("alleles")))
    return nested.attribute_rows(table(spark, d, "events").select("event_id", attrs.alias("marker")), ["event_id"], "marker", name="id", value="alleles")


@check("n14_stringified_pairs", """
SELECT p_partkey, 'size=' || p_size || ';key=' || p_partkey AS summary FROM part""")
def _(spark, d):
    pairs = F.array(F.struct(F.lit("size").alias("key"), F.col("p_size").cast("bigint").alias("value")),
                    F.when(F.col("p_size") > 100, F.struct(F.lit("never").alias("key"), F.lit(0).cast("bigint").alias("value"))),
                    F.struct(F.lit("key").alias("key"), F.col("p_partkey").alias("value")))
    df = table(spark, d, "part").select("p_partkey", nested.stringify_pairs(pairs).alias("s"))
    return df.select("p_partkey", F.array_join(F.transform("s", lambda p: F.concat(p["key"], F.lit("="), p["value"])), ";").alias("summary"))


@check("n15_unnest_struct", "SELECT p_partkey, split_part(p_brand, '#', 1) AS base_id, split_part(p_brand, '#', 2) AS version_str FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", text.split_once(F.col("p_brand"), "#", "base_id", "version_str").alias("s")).select("p_partkey", "s.*")


@check("n16_file_tree_leaves", """
WITH l AS (SELECT doc_id, source, lang, n_chars, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)
SELECT doc_id, source || '/' || lang || '/line' || i || '.txt' AS path, 'line' || i || '.txt' AS name, length(line)::BIGINT AS size, 'txt' AS type FROM l
UNION ALL SELECT doc_id, source || '/README', 'README', n_chars, NULL FROM documents""")
def _(spark, d):
    return nested.leaf_files(shapes.file_tree_docs(spark, d), ["doc_id"], "tree")


@check("n17_section_outline", f"""
WITH d AS (SELECT doc_id, lang, source, {LINES} AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d)
SELECT doc_id, 0 AS depth, 'Study' AS type, source AS accno, 2 AS n_attributes, 0 AS n_files FROM d
UNION ALL SELECT doc_id, 1, lang, '', 0, len(ls)::INTEGER FROM d
UNION ALL SELECT doc_id, 2, 'Line', 'L' || i, 1, 0 FROM l""")
def _(spark, d):
    pair = F.struct(F.lit("n").alias("name"), F.lit("v").alias("value"))
    lines = F.transform(shapes.paragraphs(F.col("text")), lambda s, i: F.struct(
        F.lit("Line").alias("type"), F.concat(F.lit("L"), i.cast("string")).alias("accno"), F.array(pair).alias("attributes")))
    files = F.transform(shapes.paragraphs(F.col("text")), lambda s: F.struct(s.alias("path")))
    body = F.struct(F.col("lang").alias("type"), files.alias("files"), lines.alias("subsections"))
    root = F.struct(F.lit("Study").alias("type"), F.col("source").alias("accno"), F.array(pair, pair).alias("attributes"),
                    F.array(body).alias("subsections"))
    docs = table(spark, d, "documents").select("doc_id", F.parse_json(F.to_json(root)).alias("tree"))
    return nested.section_outline(docs, ["doc_id"], "tree").select("doc_id", "depth", "type", "accno", "n_attributes", "n_files")


@check("n18_first_map_value", r"""
SELECT page_id, list_filter(regexp_extract_all(html, 'href="([^"]+)"', 1), lambda h: contains(h, 'a'))[1] AS first_link, regexp_extract_all(html, 'href="([^"]+)"', 1)[1] AS first_value FROM pages""")
def _(spark, d):
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    as_map = F.map_from_arrays(F.transform(links, lambda v, i: i), links)
    return table(spark, d, "pages").select("page_id", nested.first_containing(links, "a").alias("first_link"),
                                           nested.first_map_value(as_map).alias("first_value"))


@check("n19_distinct_in_order", r"""
WITH w AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link, unnest(range(len(regexp_extract_all(html, 'href="([^"]+)"', 1)))) AS i FROM pages),
f AS (SELECT page_id, link, min(i) AS i FROM w GROUP BY ALL)
SELECT page_id, link, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INTEGER AS pos FROM f""")
def _(spark, d):
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    return table(spark, d, "pages").select("page_id", F.posexplode(nested.distinct_in_order(links)).alias("pos", "link"))


@check("n20_field_discovery", """
SELECT 'k' AS key, 'bigint' AS kind, count(*) AS n_records, min(json_extract_string(props, '$.k')) AS sample FROM events""")
def _(spark, d):
    return nested.profile_json(table(spark, d, "events").select(F.parse_json("props").alias("v")), "v")


@check("n21_ragged_stack", """
SELECT s_suppkey AS key, s_name AS supplier, NULL AS customer, s_acctbal AS acctbal FROM supplier UNION ALL SELECT c_custkey, NULL, c_name, c_acctbal FROM customer""")
def _(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("supplier"), F.col("s_acctbal").alias("acctbal"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("acctbal"), F.col("c_name").alias("customer"))
    return a.unionByName(b, allowMissingColumns=True)


def motif_of(parts, *carry):
    """Four count lists per part from the letters of its name, beside columns to carry; SMALL parts lack T, size 13 has a short C."""
    letters = F.split("p_name", "")
    counts = lambda k: F.transform(letters, lambda s: F.when(F.ascii(s) % 4 == k, F.lit(3.0)).otherwise(F.lit(1.0)))
    return parts.select(
        "p_partkey", *carry, counts(0).alias("A"), F.when(F.col("p_size") == 13, F.slice(counts(1), 1, 2)).otherwise(counts(1)).alias("C"),
        counts(2).alias("G"), F.when(F.col("p_type") != "SMALL", counts(3)).alias("T"))


def motif(spark, d):
    return motif_of(spread(spark, d, "part", "p_partkey"))


MOTIF_SQL = """
l AS (SELECT p_partkey, p_name, unnest(range(length(p_name)))::INTEGER AS pos FROM part WHERE p_type <> 'SMALL' AND p_size <> 13),
m AS (SELECT p_partkey, pos, ascii(substr(p_name, pos + 1, 1)) AS c FROM l),
long AS (SELECT p_partkey, pos, b.base, CASE WHEN c % 4 = b.k THEN 3.0 ELSE 1.0 END::DOUBLE AS n FROM m, (VALUES ('A', 0), ('C', 1), ('G', 2), ('T', 3)) b(base, k))"""


@check("n22_matrix_long", f"WITH {MOTIF_SQL} SELECT p_partkey, pos, base, n FROM long")
def _(spark, d):
    return nested.matrix_long(motif(spark, d), ["p_partkey"])


@check("n23_column_sums", f"WITH {MOTIF_SQL} SELECT p_partkey, pos, sum(n) AS sites FROM long GROUP BY ALL")
def _(spark, d):
    return nested.matrix_long(motif(spark, d), ["p_partkey"]).groupBy("p_partkey", "pos").agg(F.sum("n").alias("sites"))


@check("n24_rank_columns", """
SELECT p_partkey, p_type AS superkingdom, NULL::VARCHAR AS kingdom, NULL::VARCHAR AS phylum, p_brand AS class_, NULL::VARCHAR AS "order", NULL::VARCHAR AS family,
       CASE WHEN p_size > 25 THEN p_name END AS genus, NULL::VARCHAR AS species FROM part""")
def _(spark, d):
    doc = F.to_json(F.struct(F.col("p_type").alias("super kingdom"), F.col("p_brand").alias("class"),
                             F.when(F.col("p_size") > 25, F.col("p_name")).alias("genus")))
    return table(spark, d, "part").select("p_partkey", F.parse_json(doc).alias("h")).select(
        "p_partkey", *nested.rank_columns(F.col("h"), nested.TAXON_LEVELS))


@check("n25_two_layouts", """
SELECT p_partkey, p_brand AS gene_id, p_name AS gene_name, CASE WHEN p_size > 25 THEN p_type ELSE '' END AS anatomical_entity_name, p_retailprice AS score FROM part""")
def _(spark, d):
    new = F.to_json(F.struct(F.struct(F.col("p_brand").alias("geneId"), F.col("p_name").alias("geneName")).alias("gene"),
                             F.struct(F.struct(F.col("p_type").alias("name")).alias("anatomicalEntity")).alias("condition"),
                             F.col("p_retailprice").alias("expressionScore")))
    old = F.to_json(F.struct(F.struct(F.col("p_brand").alias("geneId"), F.col("p_name").alias("name")).alias("gene"),
                             F.struct(F.lit("x").alias("other")).alias("condition"),
                             F.col("p_retailprice").alias("score"), F.lit(0.0).alias("expressionScore")))
    doc = F.when(F.col("p_size") > 25, new).otherwise(old)
    from tabularium.functions.fallback import first_truthy
    r = F.col("r")
    return table(spark, d, "part").select("p_partkey", F.parse_json(doc).alias("r")).select(
        "p_partkey", nested.pick(r, "$.gene.geneId").alias("gene_id"),
        first_truthy(nested.pick(r, "$.gene.geneName"), nested.pick(r, "$.gene.name")).alias("gene_name"),
        F.coalesce(nested.pick(r, "$.condition.anatomicalEntity.name"), nested.pick(r, "$.condition.anatEntityName"), F.lit("")).alias("anatomical_entity_name"),
        first_truthy(nested.pick(r, "$.expressionScore", "double"), nested.pick(r, "$.score", "double"), kind="number").alias("score"))


@check("n26_field_list", f"SELECT doc_id, unnest({LINES}) AS line FROM documents")
def _(spark, d):
    objects = F.transform(F.split("text", "\n"), lambda s: F.struct(F.when(F.trim(s) != "", s).alias("id")))
    kept = table(spark, d, "documents").select("doc_id", nested.field_list(objects, "id").alias("ids"))
    return kept.select("doc_id", F.explode("ids").alias("line"))


@check("n27_two_level_map", """
SELECT p_partkey, '' AS section, 'title' AS key, p_name AS value FROM part
UNION ALL SELECT p_partkey, 'meta', 'size', p_size::VARCHAR FROM part
UNION ALL SELECT p_partkey, 'meta', 'brand', p_brand FROM part""")
def _(spark, d):
    doc = F.to_json(F.struct(F.col("p_name").alias("title"),
                             F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand")).alias("meta")))
    return nested.section_rows(table(spark, d, "part").select("p_partkey", F.parse_json(doc).alias("r")), ["p_partkey"], "r")


@check("n28_relationship_id", "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand END AS sample_id FROM part")
def _(spark, d):
    data = F.when(F.col("p_size") > 25, F.struct(F.col("p_brand").alias("id")))
    doc = F.to_json(F.struct(F.struct(F.struct(data.alias("data")).alias("sample")).alias("relationships")), {"ignoreNullFields": "false"})
    return table(spark, d, "part").select("p_partkey", F.parse_json(doc).alias("r")).select(
        "p_partkey", nested.pick(F.col("r"), "$.relationships.sample.data.id").alias("sample_id"))
