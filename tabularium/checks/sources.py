"""Queries for sources, sinks and landing (S and K)."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from tabularium.checks import shapes
from tabularium.checks.registry import check, spread, table
from tabularium.operators import catalogue, manifest, profile, sinks, validate
from tabularium.session import fresh_path
from tabularium.sources import archive, delimited, landed, listing, obo, xmlsrc
from tabularium.streaming import landing


@check("s1_json_records", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, d):
    path = fresh_path(spark, "json")
    table(spark, d, "events").select(F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value")).write.text(path)
    return landed.read_json(spark, path, "event_id bigint, user_id bigint, event_type string, value double")


@check("s2_unwrap_pages", "SELECT o_orderstatus, o_orderkey // 10 AS page_no, o_orderkey AS id, o_totalprice AS price FROM orders")
def _(spark, d):
    items = landed.unwrap_pages(shapes.order_pages(spark, d), "page", ["$.hits", "$.response.result", "$"], keep=["o_orderstatus", "page_no"])
    return items.select("o_orderstatus", "page_no", F.variant_get("item", "$.id", "bigint").alias("id"),
                        F.variant_get("item", "$.price", "double").alias("price"))


PAGES_SQL = """
landed AS (SELECT o_orderpriority AS source, o_orderkey // 10 AS page, count(*) AS n FROM orders
           WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL),
declared AS (SELECT o_orderpriority AS source, count(*) AS total FROM orders GROUP BY 1)"""


def landed_pages(spark, d):
    """Pages of the orders that have lines; the declared total counts all orders, so gaps and shortfalls are real."""
    items = shapes.order_items(spark, d)
    declared = items.groupBy("source").agg(F.count("*").alias("total"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    pages = items.join(lines, "o_orderkey", "left_semi").groupBy("source", "page").agg(F.count("*").alias("n"))
    follow = F.when(F.col("n") == 1, F.col("page")).when(F.col("n") < 4, F.col("page") + 1)
    return pages.join(declared, "source").withColumn("cursor", F.col("page")).withColumn("next_cursor", follow)


BAD_PAGES = {13: '{"hits":[{"id":', 14: '{"error":"busy"}', 15: '{"hits":{"id":1}}', 16: '{"hits":[]}'}


def damaged_pages(spark, d):
    """A page per part; those of some sizes are cut short, an error, no list, an empty list or missing."""
    page = F.to_json(F.struct(F.array(F.struct(F.col("p_partkey").alias("id"))).alias("hits")))
    for size, text in BAD_PAGES.items():
        page = F.when(F.col("p_size") == size, text).otherwise(page)
    return table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") != 17, page).alias("page"))


@check("s2_rejected_pages", """
SELECT p_partkey, CASE p_size WHEN 13 THEN 'unreadable' WHEN 14 THEN 'no known envelope' WHEN 15 THEN 'wrong shape' WHEN 16 THEN 'rows: 0' WHEN 17 THEN 'unreadable' ELSE 'rows: 1' END AS outcome FROM part""")
def _(spark, d):
    pages = damaged_pages(spark, d)
    bad = landed.rejected_pages(pages, "page", ["$.hits"], keep=["p_partkey"]).select("p_partkey", F.col("reason").alias("outcome"))
    rows = landed.unwrap_pages(pages, "page", ["$.hits"], keep=["p_partkey"]).groupBy("p_partkey").agg(F.count("*").alias("n"))
    good = pages.join(bad, "p_partkey", "left_anti").join(rows, "p_partkey", "left").select(
        "p_partkey", F.concat(F.lit("rows: "), F.coalesce("n", F.lit(0)).cast("string")).alias("outcome"))
    return bad.union(good)


@check("s3_unreadable_pages", """
SELECT p_type AS source, count(*) AS n_pages, count(*) FILTER (WHERE p_size IN (13, 14, 15, 17)) AS unreadable_pages, count(*) FILTER (WHERE p_size NOT IN (13, 14, 15, 16, 17)) AS n_records,
       count(*) FILTER (WHERE p_size IN (13, 14, 15, 17)) = 0 AND max(p_partkey) - min(p_partkey) + 1 = count(*) AND count(*) FILTER (WHERE p_size <> 16) = count(*) AS complete FROM part GROUP BY 1""")
def _(spark, d):
    n = F.size(F.try_variant_get(F.try_parse_json("page"), "$.hits", "array<variant>"))
    pages = damaged_pages(spark, d).join(table(spark, d, "part").select("p_partkey", "p_type"), "p_partkey")
    total = pages.groupBy("p_type").agg(F.count("*").alias("total"))
    pages = pages.join(total, "p_type").select(F.col("p_type").alias("source"), F.col("p_partkey").alias("page_no"), n.alias("n"), "total",
                                               F.lit(0).alias("cursor"), F.lit(None).cast("int").alias("next_cursor"))
    audit = landed.page_audit(pages, "source", "page_no", "n", "total", "cursor", "next_cursor", 1)
    return audit.select("source", "n_pages", "unreadable_pages", F.coalesce("n_records", F.lit(0)).alias("n_records"), "complete")


@check("s3_page_audit", f"""
WITH {PAGES_SQL}
SELECT source, count(*) AS n_pages, min(page) AS first_page, max(page) AS last_page, sum(n)::BIGINT AS n_records, max(total) AS total,
       0::BIGINT AS unreadable_pages, 0::BIGINT AS empty_pages, count(*) FILTER (WHERE n < 10) AS short_pages, 0::BIGINT AS repeated_pages, count(*) FILTER (WHERE n = 1) AS stuck_cursors,
       count(*) FILTER (WHERE n >= 4) AS open_ends, max(page) - min(page) + 1 - count(*) AS missing_pages,
       max(page) - min(page) + 1 = count(*) AND sum(n) = max(total) AS complete
FROM landed JOIN declared USING (source) GROUP BY source""")
def _(spark, d):
    return landed.page_audit(landed_pages(spark, d), "source", "page", "n", "total", "cursor", "next_cursor", 10)


@check("s3_page_gaps", f"""
WITH {PAGES_SQL},
w AS (SELECT source, page, lead(page) OVER (PARTITION BY source ORDER BY page) AS nxt FROM landed)
SELECT source, page + 1 AS first_missing, nxt - 1 AS last_missing FROM w WHERE nxt > page + 1""")
def _(spark, d):
    return landed.page_gaps(landed_pages(spark, d), "source", "page")


@check("s4_tab_lines", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def _(spark, d):
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", "p_brand", F.col("p_size").cast("string"),
                       F.col("p_retailprice").cast("string"), F.when(F.col("p_size") > 40, F.lit("surplus")))
    lines = table(spark, d, "part").select(line.alias("line"))
    return delimited.parse_lines(lines, "line", "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double")


@check("s4_gzip_table", "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer")
def _(spark, d):
    path = fresh_path(spark, "gz")
    segment = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment"))  # short row when absent
    line = F.concat_ws(" ", F.col("c_custkey").cast("string"), "c_name", F.col("c_acctbal").cast("string"), segment)
    table(spark, d, "customer").select(line.alias("value")).write.option("compression", "gzip").text(path)
    return delimited.read_table(spark, path, "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string", sep=" ",
                                header=False, partitions=spark.sparkContext.defaultParallelism)


@check("s5_null_tokens", """
SELECT p_partkey, CASE WHEN p_size IN (13, 14, 15) THEN NULL ELSE p_name END AS p_name, p_brand FROM part""")
def _(spark, d):
    from tabularium.functions.casts import null_tokens
    name = F.when(F.col("p_size") == 13, "NA").when(F.col("p_size") == 14, " N/A ").when(F.col("p_size") == 15, "").otherwise(F.col("p_name"))
    return null_tokens(table(spark, d, "part").select("p_partkey", name.alias("p_name"), "p_brand"), ["", "NA", "N/A", "-"])


ANNOTATION_SQL = {"db": "'DB'", "db_object_id": "'O' || p_partkey", "db_object_symbol": "p_name", "go_id": "p_brand", "evidence_code": "'IEA'", "date": "'2023'"}


@check("s6_annotation_file", f"SELECT {', '.join(f'{ANNOTATION_SQL.get(n, 'NULL::VARCHAR')} AS {n}' for n in delimited.GAF_COLUMNS)} FROM part")
def _(spark, d):
    path = fresh_path(spark, "gaf")
    fields = {"db": F.lit("DB"), "db_object_id": F.concat(F.lit("O"), F.col("p_partkey").cast("string")), "db_object_symbol": F.col("p_name"),
              "go_id": F.col("p_brand"), "evidence_code": F.lit("IEA"), "date": F.lit("2023")}
    line = F.concat_ws("\t", *[fields.get(c, F.lit("")) for c in delimited.GAF_COLUMNS])
    lines = F.when(F.col("p_size") > 45, F.array(F.lit("!comment\twith tab"), line)).otherwise(F.array(line))
    table(spark, d, "part").select(F.explode(lines).alias("value")).write.option("compression", "gzip").text(path)
    return delimited.read_annotations(spark, path)


def zip_members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One archive per text: a readme and a table with one line per text line."""
    for frame in frames:
        blobs = []
        for doc_id, text in zip(frame["doc_id"], frame["text"]):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("README.md", "not a table")
                z.writestr("data.tsv", "".join(f"{doc_id}\t{i}\t{s}\n" for i, s in enumerate(text.split("\n"))))
            blobs.append(buffer.getvalue())
        yield pd.DataFrame({"path": frame["doc_id"].astype(str) + ".zip", "content": blobs})


@check("s7_zip_member", """
SELECT doc_id, unnest(range(len(string_split(text, chr(10)))))::INTEGER AS i, nullif(unnest(string_split(text, chr(10))), '') AS line FROM documents""")
def _(spark, d):
    archives = table(spark, d, "documents").select("doc_id", "text").mapInPandas(zip_members, "path string, content binary")
    lines = archive.archive_lines(archives, ".tsv")
    return delimited.parse_lines(lines, "line", "doc_id bigint, i int, line string").withColumn("line", F.nullif("line", F.lit("")))


XML_DISORDER = "OrphaCode string, Name string, ExternalReferenceList struct<ExternalReference: array<struct<Source: string, Reference: string>>>"


def escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def tag(name, c):
    return F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))


def disorder_xml():
    """One element per part: SMALL parts have no references, size above 25 has two, others one."""
    ref = lambda s, r: tag("ExternalReference", F.concat(tag("Source", F.lit(s)), tag("Reference", r)))
    one = ref("BRAND", F.col("p_brand"))
    refs = F.when(F.col("p_type") == "SMALL", F.lit("")).when(F.col("p_size") > 25, F.concat(one, ref("TYPE", F.col("p_type")))).otherwise(one)
    return tag("Disorder", F.concat(tag("OrphaCode", F.col("p_partkey").cast("string")), tag("Name", escaped(F.col("p_name"))),
                                    tag("ExternalReferenceList", refs)))


def rooted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The elements of one file inside a root element."""
    yield pd.DataFrame({"value": ["<Root><DisorderList>"]})
    yield from frames
    yield pd.DataFrame({"value": ["</DisorderList></Root>"]})


@check("s8_xml_rows", """
SELECT p_partkey AS orpha_code, p_name AS disorder_name, NULL::VARCHAR AS xref_source, NULL::VARCHAR AS xref_id FROM part WHERE p_type = 'SMALL'
UNION ALL SELECT p_partkey, p_name, 'BRAND', p_brand FROM part WHERE p_type <> 'SMALL'
UNION ALL SELECT p_partkey, p_name, 'TYPE', p_type FROM part WHERE p_type <> 'SMALL' AND p_size > 25""")
def _(spark, d):
    path = fresh_path(spark, "xml")
    spread(spark, d, "part", "p_partkey").select(disorder_xml().alias("value")).mapInPandas(rooted, "value string").write.text(path)
    rows = xmlsrc.read_xml(spark, path, "Disorder", XML_DISORDER)
    return rows.select(F.col("OrphaCode").try_cast("bigint").alias("orpha_code"), F.col("Name").alias("disorder_name"),
                       F.explode_outer("ExternalReferenceList.ExternalReference").alias("x")).select(
        "orpha_code", "disorder_name", F.col("x.Source").alias("xref_source"), F.col("x.Reference").alias("xref_id"))


def compound_xml():
    """Namespaced answer per part with two data items; the mass item is missing for SMALL parts."""
    item = lambda k, v: tag("c:ChemicalDataItem", F.concat(tag("c:datatype", F.lit(k)), tag("c:data", v)))
    mass = F.when(F.col("p_type") != "SMALL", item("MONOISOTOPIC MASS", F.col("p_retailprice").cast("string"))).otherwise("")
    body = F.concat(tag("c:chebiId", F.concat(F.lit("CHEBI:"), F.col("p_partkey").cast("string"))), tag("c:chebiAsciiName", escaped(F.col("p_name"))),
                    item("CHARGE", F.lit("1")), mass, tag("c:charge", F.col("p_size").cast("string")))
    return F.concat(F.lit('<S:Envelope xmlns:S="urn:s" xmlns:c="urn:c"><S:Body><c:return>'), body, F.lit("</c:return></S:Body></S:Envelope>"))


@check("s9_xml_fields", "SELECT 'CHEBI:' || p_partkey AS chebi_id, p_name AS name, p_size::VARCHAR AS charge, '' AS smiles FROM part")
def _(spark, d):
    docs = spread(spark, d, "part", "p_partkey").select(compound_xml().alias("doc"))
    path = xmlsrc.text_path
    return xmlsrc.xml_fields(docs, "doc", {"chebi_id": path("chebiId"), "name": path("chebiAsciiName"), "charge": path("charge"), "smiles": path("smiles")})


@check("s10_xml_item", "SELECT p_partkey, CASE WHEN p_type <> 'SMALL' THEN p_retailprice END AS mass FROM part")
def _(spark, d):
    item = xmlsrc.xml_item(F.col("doc"), "ChemicalDataItem", "datatype", "MONOISOTOPIC MASS", "data")
    return spread(spark, d, "part", "p_partkey").select("p_partkey", compound_xml().alias("doc")).select(
        "p_partkey", F.nullif(item, F.lit("")).try_cast("double").alias("mass"))


@check("s11_ontology_edges", """
SELECT 'P:' || p_partkey AS child_id, CASE WHEN p_size > 45 THEN '' ELSE p_name END AS child_name, 'T:' || p_type AS parent_id, 'is_a' AS relation FROM part
UNION ALL SELECT 'P:' || p_partkey, CASE WHEN p_size > 45 THEN '' ELSE p_name END, 'B:' || p_brand, 'has_role' FROM part WHERE p_size > 25""")
def _(spark, d):
    path = fresh_path(spark, "obo")
    name = F.when(F.col("p_size") <= 45, F.concat(F.lit("name: "), F.col("p_name"), F.lit("\n"))).otherwise("")
    role = F.when(F.col("p_size") > 25, F.concat(F.lit("\nrelationship: has_role B:"), F.col("p_brand"), F.lit(" ! brand"))).otherwise("")
    term = F.concat(F.lit("[Term]\nid: P:"), F.col("p_partkey").cast("string"), F.lit("\n"), name, F.lit("is_a: T:"), F.col("p_type"), F.lit(" ! type"), role, F.lit("\n"))
    other = F.concat(F.lit("[Typedef]\nid: has_role\nname: role\nis_a: T:"), F.col("p_type"), F.lit("\n"))
    stanzas = F.when(F.col("p_size") > 40, F.array(term, other)).otherwise(F.array(term))
    table(spark, d, "part").select(F.explode(stanzas).alias("value")).write.text(path)
    return obo.term_edges(obo.read_stanzas(spark, path))


@check("s12_parquet_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@check("s13_lazy_count", "SELECT count(*) AS n_rows FROM lineitem")
def _(spark, d):
    return catalogue.row_count(table(spark, d, "lineitem"))


@check("s14_files_per_category", "SELECT p_type AS category, p_partkey AS lm_id, p_name AS name FROM part")
def _(spark, d):
    path = fresh_path(spark, "cat")
    rows = table(spark, d, "part").select("p_type", F.to_json(F.struct(F.col("p_partkey").alias("lm_id"), F.col("p_name").alias("name"))).alias("value"))
    rows.write.partitionBy("p_type").text(path)
    return landed.read_by_category(spark, f"{path}/p_type=*", "lm_id bigint, name string", "p_type=([^/]+)/")


@check("s15_stack_text_pages", "SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> ''")
def _(spark, d):
    page = F.concat(F.lit("Entry\tName\n"), F.col("text"))
    pages = table(spark, d, "documents").select("doc_id", F.lit(0).alias("page_no"), page.alias("body"))
    return landed.stack_text_pages(pages, "page_no", "body", keep=["doc_id"]).select("doc_id", "line")


LISTING_SQL = """
listing AS (SELECT p_partkey, replace(p_name, ' ', '_') || ' ' || p_partkey || CASE WHEN p_size > 25 THEN '.CZI' ELSE '' END AS name,
  CASE WHEN p_type = 'SMALL' THEN 'dir' ELSE 'file' END AS kind, p_partkey * 1000 + p_size AS size_bytes, round((p_partkey * 1000 + p_size) / 1e6, 3) AS size_mb,
  CASE WHEN p_size > 25 THEN '.czi' ELSE '(none)' END AS extension, p_size FROM part WHERE p_size <> 13)"""


@check("s16_listing_lines", f"WITH {LISTING_SQL} SELECT p_partkey, name, kind, size_bytes, size_mb, extension, 'passive' AS mode FROM listing")
def _(spark, d):
    return listing.parse_listing(shapes.listing_lines(spark, d), "line", keep=["p_partkey"], mode="passive")


@check("s17_acquisition_xml", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS n_channels, 'DAPI (405)' || CASE WHEN p_size > 25 THEN ' | ' || p_brand ELSE '' END AS channels,
       round(p_size * 1e-7 * 1e6, 4) AS px_um_x, CASE WHEN p_size > 40 THEN 2.0 END::DOUBLE AS px_um_z,
       TIMESTAMP '2020-01-01 10:30:15.123456' + INTERVAL 1 DAY * p_size AS created, p_type AS objective, CASE WHEN p_type = 'SMALL' THEN NULL ELSE '20' END AS magnification,
       NULL::DOUBLE AS px_um_y, NULL::VARCHAR AS na, NULL::VARCHAR AS error FROM part""")
def _(spark, d):
    size = F.col("p_size")
    dist = lambda a, v: F.concat(F.lit(f'<Distance Id="{a}"><Value>'), v, F.lit("</Value></Distance>"))
    scaling = tag("Scaling", tag("Items", F.concat(dist("X", F.concat(size.cast("string"), F.lit("e-7"))),
                                                   F.when(size > 40, dist("Z", F.lit("2e-6"))).otherwise(""))))
    channels = F.concat(F.lit('<Channel Id="C0" Name="DAPI"><Fluor>405</Fluor></Channel>'),
                        F.when(size > 25, F.concat(F.lit('<Channel Id="C1" Name="'), F.col("p_brand"), F.lit('"><Fluor>Brand</Fluor></Channel>'))).otherwise(""))
    created = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), size), "yyyy-MM-dd'T12:30:15.1234567+02:00'")
    magnification = F.when(F.col("p_type") != "SMALL", F.lit("<NominalMagnification>20</NominalMagnification>")).otherwise("")
    objective = tag("Objective", F.concat(tag("Manufacturer", tag("Model", F.col("p_type"))), magnification))
    info = tag("Information", F.concat(tag("Document", tag("CreationDate", created)),
                                       tag("Image", tag("Dimensions", tag("Channels", channels))),
                                       tag("Instrument", tag("Objectives", objective))))
    doc = tag("ImageDocument", tag("Metadata", F.concat(scaling, info)))
    df = spread(spark, d, "part").select("p_partkey", doc.alias("doc"))
    return xmlsrc.select_acquisition(df, "doc", keep=["p_partkey"])


# Handling days per order priority.
PRIORITY_DAYS = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 5)]


@check("s18_literal_table", """
SELECT o_orderkey, days FROM orders LEFT JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 5)) v(p, days) ON p = o_orderpriority""")
def _(spark, d):
    days = spark.createDataFrame(PRIORITY_DAYS, "o_orderpriority string, days int")
    return table(spark, d, "orders").select("o_orderkey", "o_orderpriority").join(F.broadcast(days), "o_orderpriority", "left").drop("o_orderpriority")


@check("s19_empty_profile", "SELECT * FROM (VALUES ('ec_number', 0::BIGINT, NULL::DOUBLE), ('km_value', 0::BIGINT, NULL::DOUBLE)) t(\"column\", nulls, null_pct) WHERE (SELECT count(*) FROM lineitem WHERE l_quantity < 0) = 0")
def _(spark, d):
    none = table(spark, d, "lineitem").where("l_quantity < 0").select(F.col("l_returnflag").alias("ec_number"), F.col("l_quantity").alias("km_value"))
    return profile.null_rates(none)


@check("s19_typed_empty", "SELECT l_returnflag AS ec_number, count(*) AS n FROM lineitem GROUP BY 1")
def _(spark, d):
    schema = "ec_number string, km_value double"
    parsed = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("ec_number"), F.col("l_quantity").alias("km_value"))
    empty = spark.createDataFrame([], schema)
    return empty.unionByName(parsed).groupBy("ec_number").agg(F.count("*").alias("n"))


@check("s20_keyed_map", "SELECT event_id, 'k' AS key, json_extract_string(props, '$.k')::BIGINT AS value FROM events")
def _(spark, d):
    return landed.keyed_rows(table(spark, d, "events"), "props", "bigint", keep=["event_id"])


@check("s21_field_catalogue", """
SELECT source, unnest(['text', 'lang', 'n_chars']) AS column_id, unnest(['string', 'string', 'bigint']) AS column_type, count(*) AS n FROM documents GROUP BY source""")
def _(spark, d):
    doc = F.to_json(F.array(*[F.struct(F.lit(n).alias("columnId"), F.lit(t).alias("type")) for n, t in (("text", "string"), ("lang", "string"), ("n_chars", "bigint"))]))
    fields = table(spark, d, "documents").select("source", F.inline(F.from_json(doc, "array<struct<columnId: string, type: string>>")))
    return fields.groupBy("source", F.col("columnId").alias("column_id"), F.col("type").alias("column_type")).agg(F.count("*").alias("n"))


# ---- sinks and landing -----------------------------------------------------

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"


def some_orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@check("k1_parquet_round_trip", ORDERS_SQL)
def _(spark, d):
    return sinks.write_parquet(some_orders(spark, d), fresh_path(spark, "pq"), partition_by=["o_orderstatus"]).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@check("k2_zstd", ORDERS_SQL)
def _(spark, d):
    return sinks.write_parquet(some_orders(spark, d), fresh_path(spark, "zstd"), codec="zstd")


@check("k3_json_round_trip", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey, o_totalprice FROM orders")
def _(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"), "o_totalprice")
    return sinks.write_json(df, fresh_path(spark, "json"))


@check("k4_round_trip_check", "SELECT count(*) AS n_left, count(*) AS n_right, 0::BIGINT AS n_differ, true AS same_schema, true AS ok FROM orders")
def _(spark, d):
    df = some_orders(spark, d)
    return sinks.same_rows(df, sinks.write_parquet(df, fresh_path(spark, "check")))


def landed_manifest(spark, d):
    """Listed files of which those up to size 25 are landed; size 20 is landed with other bytes."""
    listed = listing.parse_listing(shapes.listing_lines(spark, d), "line", keep=["p_size"])
    done = listed.filter(F.col("extension") == "(none)").select(
        "name", F.when(F.col("p_size") == 20, F.col("size_bytes") - 1).otherwise(F.col("size_bytes")).alias("size_bytes"))
    return listed, done


@check("k5_to_land", f"WITH {LISTING_SQL} SELECT name, size_bytes FROM listing WHERE p_size > 25 OR p_size = 20")
def _(spark, d):
    return manifest.to_land(*landed_manifest(spark, d)).select("name", "size_bytes")


@check("k5_file_stream", "SELECT o_orderstatus AS status, o_orderkey AS id, o_totalprice AS price FROM orders")
def _(spark, d):
    base = fresh_path(spark, "stream")
    pages, out, state = f"{base}/pages", f"{base}/out", f"{base}/state"
    envelope = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.array(F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))).alias("hits")))

    def flatten(df):
        return df.select(F.from_json("value", "status string, hits array<struct<id: bigint, price: double>>").alias("r")).select(
            "r.status", F.inline("r.hits"))

    # Two arrivals, two runs with one checkpoint: the second run reads the new files only.
    for arrival in (F.col("o_orderstatus") == "O", F.col("o_orderstatus") != "O"):
        table(spark, d, "orders").filter(arrival).select(envelope.alias("value")).write.mode("append").text(pages)
        landing.land_new(landing.page_stream(spark, pages), flatten, out, state)
    return spark.read.schema("status string, id bigint, price double").parquet(out)


@check("k6_prefix_guard", """
SELECT source, count(*) AS n_keys, count(*) FILTER (WHERE NOT (lang LIKE 'e%' OR lang LIKE 'f%')) AS n_foreign, bool_and(lang LIKE 'e%' OR lang LIKE 'f%') AS valid FROM documents GROUP BY 1""")
def _(spark, d):
    return validate.prefix_guard(table(spark, d, "documents"), "lang", ["e", "f"], by=["source"])


@check("k7_stored_files", "SELECT true AS has_files, count(*) AS n_rows, true AS has_bytes FROM orders")
def _(spark, d):
    path = fresh_path(spark, "stored")
    sinks.write_parquet(some_orders(spark, d), path, codec="zstd")
    return catalogue.stored_files(spark, path).agg((F.count("*") > 0).alias("has_files"), F.sum("n_rows").alias("n_rows"), (F.min("n_bytes") > 0).alias("has_bytes"))


@check("k8_land_report", f"""
WITH {LISTING_SQL}
SELECT count(*) AS n_planned, count(*) FILTER (WHERE p_size <= 25 AND p_size <> 20) AS n_skipped, count(*) FILTER (WHERE p_size > 25 OR p_size = 20) AS n_todo,
       sum(size_bytes)::BIGINT AS bytes_planned, coalesce(sum(size_bytes) FILTER (WHERE p_size <= 25 AND p_size <> 20), 0)::BIGINT AS bytes_skipped,
       coalesce(sum(size_bytes) FILTER (WHERE p_size > 25 OR p_size = 20), 0)::BIGINT AS bytes_todo FROM listing""")
def _(spark, d):
    return manifest.land_report(*landed_manifest(spark, d))
