"""Landed page files: reading, unwrapping envelopes, auditing page sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions.rows import item_rows, struct_rows


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per landed file (file, page text); a file is one JSON document."""
    return (spark.read.text(path, wholetext=True)
                 .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("page")))


def read_json(spark: SparkSession, path: str | list[str], schema: str | T.StructType, multi_line: bool = False) -> DataFrame:
    """JSON records with a declared schema; nothing is inferred. JSON lines can be split, so prefer them."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def record_list(page: Column, paths: Sequence[str]) -> Column:
    """Record list of an envelope: the first path that holds a non-empty list; ``$`` is a bare list."""
    lists = [F.try_variant_get(page, p, "array<variant>") for p in paths]
    return lists[0] if len(lists) == 1 else F.get(F.filter(F.array(*lists), lambda a: F.size(a) > 0), F.lit(0))


def page_fault(parsed: Column, paths: Sequence[str]) -> Column:
    """Why a parsed page has no record list, or null if it has one, if only an empty one."""
    lists = [F.try_variant_get(parsed, p, "array<variant>").isNotNull() for p in paths]
    named = [F.try_variant_get(parsed, p, "variant").isNotNull() for p in paths if p != "$"]
    any_of = lambda tests: F.exists(F.array(F.lit(False), *tests), lambda t: t)
    return (F.when(parsed.isNull(), "unreadable").when(any_of(lists), None)
             .when(any_of(named), "wrong shape").otherwise("no known envelope"))


def unwrap_pages(df: DataFrame, page: str, paths: Sequence[str], keep: Sequence[str] = (), item: str = "item",
                 strict: bool = False) -> DataFrame:
    """One row per record of each page; ``page`` is JSON text.

    A page that cannot be read or has none of the envelopes gives no rows here and one in
    ``rejected_pages``; with ``strict`` it fails the job. Only a known empty list is silent.
    """
    parsed = df.select(*keep, F.try_parse_json(page).alias("_page"))
    if strict:
        parsed = refuse(parsed, page_fault(F.col("_page"), paths))
    return item_rows(parsed, keep, record_list(F.col("_page"), paths), item)


def rejected_pages(df: DataFrame, page: str, paths: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The pages that ``unwrap_pages`` can make nothing of, with the reason."""
    parsed = df.select(*keep, F.try_parse_json(page).alias("_page"))
    return parsed.select(*keep, page_fault(F.col("_page"), paths).alias("reason")).where(F.col("reason").isNotNull())


def refuse(df: DataFrame, fault: Column) -> DataFrame:
    """The same rows; one with a fault fails the job."""
    return df.where(F.when(fault.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("rejected: "), fault)).cast("boolean")))


def page_audit(df: DataFrame, source: str, page: str, n_records: str, total: str, cursor: str, next_cursor: str,
               page_size: int) -> DataFrame:
    """One row per source that says whether its landed page set is complete.

    All measures are sums, extremes and counts over pages, so a source with most of the
    pages is aggregated in parallel. ``stuck_cursors`` counts pages whose next cursor is
    their own; ``open_ends`` pages without a next cursor (a finished set has one). A page whose
    number of records is null could not be read; with one, the set is not complete.
    """
    per_page = df.groupBy(source, page).agg(
        F.count("*").alias("_copies"), F.max(n_records).alias("_n"), F.max(total).alias("_total"),
        F.max(F.coalesce(F.col(cursor) == F.col(next_cursor), F.lit(False)).cast("int")).alias("_stuck"),
        F.max(F.col(next_cursor).isNull().cast("int")).alias("_end"))
    audit = per_page.groupBy(source).agg(
        F.count("*").alias("n_pages"), F.min(page).alias("first_page"), F.max(page).alias("last_page"),
        F.sum("_n").alias("n_records"), F.max("_total").alias("total"),
        F.sum(F.col("_n").isNull().cast("int")).alias("unreadable_pages"),
        F.sum(F.coalesce(F.col("_n") == 0, F.lit(False)).cast("int")).alias("empty_pages"),
        F.sum(F.coalesce(F.col("_n") < page_size, F.lit(False)).cast("int")).alias("short_pages"),
        F.sum(F.col("_copies") - 1).alias("repeated_pages"),
        F.sum("_stuck").alias("stuck_cursors"), F.sum("_end").alias("open_ends"))
    missing = F.col("last_page") - F.col("first_page") + 1 - F.col("n_pages")
    return audit.select("*", missing.alias("missing_pages"),
                        ((missing == 0) & (F.col("unreadable_pages") == 0)
                         & F.coalesce(F.col("n_records") == F.col("total"), F.lit(False))).alias("complete"))


def page_gaps(df: DataFrame, source: str, page: str, bucket: int = 100_000) -> DataFrame:
    """Runs of missing page numbers per source (first_missing, last_missing), from one pass.

    A page adds 1 at its number and takes 1 at the next; what does not cancel is the start of a
    run of pages or the place after one. These are paired per source and bucket of page
    numbers, so a source with most of the pages is dealt over many tasks; of each bucket only
    the outer two meet those of its neighbours.
    """
    pages = df.select(F.col(source), F.col(page).cast("bigint").alias("_p")).where(F.col("_p").isNotNull()).distinct()
    step = F.array(F.struct(F.col("_p").alias("at"), F.lit(1).alias("d")), F.struct((F.col("_p") + 1).alias("at"), F.lit(-1).alias("d")))
    edges = (pages.select(source, F.explode(step).alias("_s")).groupBy(source, F.col("_s.at").alias("_at")).agg(F.sum("_s.d").alias("_d"))
             .where("_d <> 0").withColumn("_b", F.floor(F.col("_at") / bucket)))
    inside = Window.partitionBy(source, "_b").orderBy("_at")
    paired = edges.withColumn("_next", F.lead("_at").over(inside))
    gaps = paired.where("_d < 0 AND _next IS NOT NULL").select(source, "_at", "_next")
    # One row per bucket with an edge: does it end in an open gap, and where does its first run start.
    outer = edges.groupBy(source, "_b").agg(F.max(F.struct("_at", "_d")).alias("_last"), F.min("_at").alias("_first"))
    across = outer.select(source, F.col("_last._at").alias("_at"), F.col("_last._d").alias("_d"),
                          F.lead("_first").over(Window.partitionBy(source).orderBy("_b")).alias("_next"))
    border = across.where("_d < 0 AND _next IS NOT NULL").select(source, "_at", "_next")
    return gaps.union(border).select(source, F.col("_at").alias("first_missing"), (F.col("_next") - 1).alias("last_missing"))


def read_by_category(spark: SparkSession, paths: str | list[str], schema: str | T.StructType, pattern: str) -> DataFrame:
    """JSON-lines files of several categories stacked, the category cut out of the file path."""
    return (spark.read.schema(schema).json(paths)
                 .select("*", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).alias("category")))


def stack_text_pages(df: DataFrame, order: str, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Lines of text pages without the header line that each page repeats."""
    lines = df.select(*keep, order, F.posexplode(F.split(text, "\n")).alias("_i", "line"))
    return lines.filter((F.col("_i") > 0) & (F.col("line") != "")).drop("_i")


def keyed_rows(df: DataFrame, doc: str, value_type: str, key: str = "key", value: str = "value",
               keep: Sequence[str] = ()) -> DataFrame:
    """One row per entry of a document that is a map from id to record."""
    entries = F.map_entries(F.from_json(doc, f"map<string,{value_type}>"))
    return struct_rows(df, keep, entries, ["key", "value"]).withColumnsRenamed({"key": key, "value": value})
