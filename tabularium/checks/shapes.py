"""Raw records in the accepted shapes, made row by row from the given tables.

Each builder is a projection: no row is dropped and nothing is gathered, so the raw data
grows with the table. Bad cases (missing key, blank, wrong type, duplicate name) are planted
by value, and the SQL of a query plants the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.checks.registry import table


def attr(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def part_attributes() -> Column:
    """Attributes of a part.

    Title is blank for STANDARD parts; Brand comes twice from size 41 (the second says
    ``other``); Type is absent for SMALL parts; sizes 13 and 14 read ``n/a`` and ``7.5``.
    """
    size = F.when(F.col("p_size") == 13, "n/a").when(F.col("p_size") == 14, "7.5").otherwise(F.col("p_size").cast("string"))
    items = F.array(
        attr("Title", F.when(F.col("p_type") == "STANDARD", "").otherwise(F.col("p_name"))),
        attr("Brand", F.col("p_brand")),
        F.when(F.col("p_size") > 40, attr("Brand", F.lit("other"))),
        F.when(F.col("p_type") != "SMALL", attr("Type", F.col("p_type"))),
        attr("Number of samples", size))
    return F.filter(items, lambda a: a.isNotNull())


def part_records(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON record per part (p_partkey, record)."""
    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd")
    record = F.struct(
        F.concat(F.lit("E-"), F.col("p_partkey").cast("string")).alias("accession"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") == 20, "2020-1-2").when(F.col("p_size") != 21, day).alias("releaseDate"),
        F.when(F.col("p_size") > 45, F.col("p_size")).alias("numberOfComponents"),
        part_attributes().alias("attributes"))
    return table(spark, folder, "part").select("p_partkey", F.to_json(record).alias("record"))


ORDER_PAGE = 10


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the source and page they are landed under; a page holds one key range."""
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("source"), F.expr(f"o_orderkey div {ORDER_PAGE}").alias("page"),
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def order_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Page envelopes of at most ten orders: (o_orderstatus, page_no, page).

    Status O uses ``hits``, F ``response.result`` and P is a bare list.
    """
    item = F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), F.col("o_totalprice").alias("price"))
    pages = (table(spark, folder, "orders")
             .groupBy("o_orderstatus", F.expr("o_orderkey div 10").alias("page_no"))
             .agg(F.array_sort(F.collect_list(item)).alias("items")))
    page = (F.when(F.col("o_orderstatus") == "O", F.to_json(F.struct(F.col("items").alias("hits"), F.size("items").alias("totalHits"))))
             .when(F.col("o_orderstatus") == "F", F.to_json(F.struct(F.struct(F.col("items").alias("result")).alias("response"))))
             .otherwise(F.to_json("items")))
    return pages.select("o_orderstatus", "page_no", page.alias("page"))


def paragraphs(text: Column) -> Column:
    """Non-blank lines of a text."""
    return F.filter(F.split(text, "\n"), lambda s: F.trim(s) != "")


def file_tree_docs(spark: SparkSession, folder: str) -> DataFrame:
    """One file tree per document: source / language / lines, plus a lone summary file (doc_id, tree)."""
    line_files = F.transform(F.split("text", "\n"), lambda s, i: F.struct(
        F.concat(F.lit("line"), i.cast("string"), F.lit(".txt")).alias("name"), F.length(s).alias("size")))
    inner = F.struct(F.col("lang").alias("name"), line_files.alias("files"))
    summary = F.struct(F.lit("README").alias("name"), F.col("n_chars").alias("size"))
    tree = F.concat(F.lit('{"name":"'), F.col("source"), F.lit('","files":['), F.to_json(inner), F.lit(","),
                    F.to_json(summary), F.lit("]}"))
    return table(spark, folder, "documents").select("doc_id", F.parse_json(tree).alias("tree"))


def listing_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Directory lines of parts: SMALL parts are folders, size 13 gives a line with too few fields."""
    name = F.concat(F.translate("p_name", " ", "_"), F.lit(" "), F.col("p_partkey").cast("string"),
                    F.when(F.col("p_size") > 25, F.lit(".CZI")).otherwise(F.lit("")))
    perms = F.when(F.col("p_type") == "SMALL", "drwxr-xr-x").otherwise("-rw-r--r--")
    bytes_ = (F.col("p_partkey") * 1000 + F.col("p_size")).cast("string")
    line = F.when(F.col("p_size") == 13, F.concat_ws(" ", perms, F.lit("2 ftp ftp"))).otherwise(
        F.concat_ws("  ", perms, F.lit("2 ftp ftp"), bytes_, F.lit("Mar 22 2023"), name))
    return table(spark, folder, "part").select("p_partkey", "p_size", line.alias("line"))


def geo_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Hierarchy edges: region to root, nation to region, supplier and customer to nation.

    Customers in debt hang on a nation by ``has_part``; nations also hang on the region before theirs,
    which makes the graph a DAG.
    """
    def edges(df: DataFrame, child: Column, parent: Column, relation: Column) -> DataFrame:
        return df.select(child.alias("child_id"), parent.alias("parent_id"), relation.alias("relation"))

    is_a = F.lit("is_a")
    root = F.when(F.col("r_regionkey").isNotNull(), "ROOT")
    node = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer")
    return (edges(table(spark, folder, "region"), node("R", "r_regionkey"), root, is_a)
            .union(edges(nation, node("N", "n_nationkey"), node("R", "n_regionkey"), is_a))
            .union(edges(nation.filter("n_regionkey > 0"), node("N", "n_nationkey"), F.concat(F.lit("R"), F.expr("string(n_regionkey - 1)")), is_a))
            .union(edges(table(spark, folder, "supplier"), node("S", "s_suppkey"), node("N", "s_nationkey"), is_a))
            .union(edges(customer, node("C", "c_custkey"), node("N", "c_nationkey"),
                         F.when(F.col("c_acctbal") < 0, "has_part").otherwise("is_a"))))


GEO_EDGES_SQL = """
edges AS (
  SELECT 'R' || r_regionkey AS child_id, 'ROOT' AS parent_id, 'is_a' AS relation FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, 'is_a' FROM nation
  UNION ALL SELECT 'N' || n_nationkey, 'R' || (n_regionkey - 1), 'is_a' FROM nation WHERE n_regionkey > 0
  UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, 'is_a' FROM supplier
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, CASE WHEN c_acctbal < 0 THEN 'has_part' ELSE 'is_a' END FROM customer
)"""
