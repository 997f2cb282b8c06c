"""Flattening of nested records: lists, attribute lists, maps, trees and matrices."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions.rows import item_rows, struct_rows


# ---- variant access -------------------------------------------------------

def pick(record: Column, path: str, dtype: str = "string") -> Column:
    """Value at a path of a VARIANT record; null when absent or of another shape."""
    return F.try_variant_get(record, path, dtype)


def items_of(record: Column, path: str) -> Column:
    """List at a path as ``array<variant>``; null when absent or no list."""
    return F.try_variant_get(record, path, "array<variant>")


def item_or_first(record: Column, path: str, field: str = "", dtype: str = "string") -> Column:
    """Field of the object at a path, or of its first item where the path holds a list.

    ``field`` continues the path (for example ``.name``); empty takes the value itself.
    """
    return F.coalesce(
        F.try_variant_get(record, f"{path}[0]{field}", dtype),
        F.try_variant_get(record, f"{path}{field}", dtype),
    )


def list_or_count(record: Column, path: str) -> Column:
    """Number of items where the path holds a list, the number itself where it holds one, else 0."""
    return F.coalesce(F.size(items_of(record, path)), F.try_variant_get(record, path, "int"), F.lit(0))


def kind_of(record: Column) -> Column:
    """Coarse kind of a VARIANT value: object, list or scalar type name in lower case."""
    schema = F.schema_of_variant(record)
    return (F.when(schema.startswith("OBJECT"), F.lit("object"))
             .when(schema.startswith("ARRAY"), F.lit("list"))
             .otherwise(F.lower(F.regexp_replace(schema, "\\(.*", ""))))


# ---- lists ----------------------------------------------------------------

def first_item(items: Column) -> Column:
    """First item, null for an empty or missing list."""
    return F.get(items, F.lit(0))


def list_size(items: Column) -> Column:
    """Number of items of a list or map, 0 when missing."""
    return F.coalesce(F.size(items), F.lit(0))


def has_items(items: Column) -> Column:
    """Whether a list has at least one item."""
    return F.coalesce(F.size(items), F.lit(0)) > 0


def count_where(items: Column, test: Callable[[Column], Column]) -> Column:
    """Number of items that pass a test, 0 for a missing list."""
    return list_size(F.filter(items, test))


def field_list(items: Column, field: str) -> Column:
    """One field of each struct, blanks and nulls dropped, kept as an array."""
    return F.filter(F.transform(items, lambda x: x[field]), lambda v: v.isNotNull() & (v != ""))


def join_list(items: Column, sep: str = " | ", keep_blank: bool = False, distinct: bool = False,
              order: bool = False) -> Column:
    """Items as delimited text, null when nothing is left.

    ``keep_blank`` keeps empty items; ``distinct`` drops repeats in first-seen order;
    ``order`` sorts, which also makes the text of a set deterministic.
    """
    kept = items if keep_blank else F.filter(items, lambda v: v.isNotNull() & (v != ""))
    if distinct:
        kept = F.array_distinct(kept)
    if order:
        kept = F.array_sort(kept)
    return F.nullif(F.array_join(kept, sep), F.lit(""))


def strip_outer(text: Column, chars: str = " |") -> Column:
    """Text without leading and trailing separator characters, null when nothing is left."""
    return F.nullif(F.btrim(text, F.lit(chars)), F.lit(""))


def distinct_in_order(items: Column) -> Column:
    """Distinct items in first-seen order."""
    return F.array_distinct(items)


def stringify_pairs(pairs: Column, key: str = "key", value: str = "value") -> Column:
    """List of key/value structs with both sides as text; null items are dropped."""
    return F.transform(
        F.filter(pairs, lambda p: p.isNotNull()),
        lambda p: F.struct(p[key].cast("string").alias("key"), p[value].cast("string").alias("value")),
    )


# ---- attribute lists ------------------------------------------------------

def kv_get(attrs: Column, key: str, keep: str = "first", ignore_case: bool = False, name: str = "name",
           value: str = "value", skip_blank: bool = False) -> Column:
    """Value of an attribute in a list of name/value structs, null when absent.

    With repeated names the ``first`` or the ``last`` one wins. ``skip_blank`` passes over
    attributes without a value, so that a later filled one can win.
    """
    def wanted(a: Column) -> Column:
        label = F.lower(a[name]) if ignore_case else a[name]
        hit = label == F.lit(key.lower() if ignore_case else key)
        return hit & a[value].isNotNull() & (a[value] != "") if skip_blank else hit

    hits = F.filter(attrs, wanted)
    hit = F.get(hits, F.lit(0)) if keep == "first" else F.get(hits, F.size(hits) - 1)
    return hit[value]


def pivot_known(attrs: Column, columns: Mapping[str, str], keep: str = "last", **names: str) -> list[Column]:
    """One column per known attribute name; all other names are ignored."""
    return [kv_get(attrs, key, keep=keep, **names).alias(column) for key, column in columns.items()]


def attribute_rows(df: DataFrame, ids: Sequence[str], attrs: str, name: str = "name", value: str = "value") -> DataFrame:
    """The long form of attribute lists: (ids..., key, value), the last value of a name winning."""
    last = F.transform(F.array_distinct(F.transform(F.filter(attrs, lambda a: a[name].isNotNull()), lambda a: a[name])),
                       lambda k: F.struct(k.alias("key"), F.element_at(F.filter(attrs, lambda a: a[name] == k), -1)[value].alias("value")))
    return struct_rows(df, ids, last, ["key", "value"])


def attribute_names(df: DataFrame, attrs: str, name: str = "name") -> DataFrame:
    """The distinct attribute names (key): the step that finds the columns of a pivot, when the format does not fix them."""
    return item_rows(df, [], F.col(attrs), "a").select(F.col(f"a.{name}").alias("key")).filter(F.col("key").isNotNull()).distinct()


def pivot_keys(df: DataFrame, ids: Sequence[str], attrs: str, prefix: str, keys: Sequence[str], name: str = "name",
               value: str = "value") -> DataFrame:
    """One ``prefix + name`` column per given attribute name, the last value winning.

    The lists stay in their row: no shuffle carries them. Names that are not given are ignored;
    ``attribute_rows`` keeps them all.
    """
    return df.select(*ids, *[kv_get(F.col(attrs), k, keep="last", name=name, value=value).alias(f"{prefix}{k}") for k in sorted(set(keys))])


# ---- maps -----------------------------------------------------------------

def first_map_value(m: Column) -> Column:
    """First value of a map, null for an empty one."""
    return F.get(F.map_values(m), F.lit(0))


def first_containing(items: Column, text: str) -> Column:
    """First item that contains a text."""
    return F.get(F.filter(items, lambda v: F.contains(v, F.lit(text))), F.lit(0))


def section_rows(df: DataFrame, ids: Sequence[str], record: str) -> DataFrame:
    """Two-level VARIANT map as (section, key, value) rows.

    A scalar at the top level has an empty section; an object gives one row per inner key.
    """
    top = struct_rows(df, ids, F.map_entries(F.try_variant_get(record, "$", "map<string,variant>")), ["key", "value"])
    top = top.withColumnsRenamed({"key": "_k", "value": "_v"})
    inner = F.try_variant_get("_v", "$", "map<string,variant>")
    pairs = F.when(
        inner.isNotNull(),
        F.transform(F.map_entries(inner), lambda e: F.struct(
            F.col("_k").alias("section"), e["key"].alias("key"), F.try_variant_get(e["value"], "$", "string").alias("value"))),
    ).otherwise(F.array(F.struct(
        F.lit("").alias("section"), F.col("_k").alias("key"), F.try_variant_get("_v", "$", "string").alias("value"))))
    return struct_rows(top, ids, pairs, ["section", "key", "value"])


def profile_json(df: DataFrame, record: str) -> DataFrame:
    """Field discovery: key, kind, number of records and a sample value per key and kind."""
    pairs = struct_rows(df, [], F.map_entries(F.try_variant_get(record, "$", "map<string,variant>")), ["key", "value"])
    return (pairs.select("key", kind_of(F.col("value")).alias("kind"), F.try_variant_get("value", "$", "string").alias("_t"))
                 .groupBy("key", "kind").agg(F.count("*").alias("n_records"), F.min("_t").alias("sample")))


# ---- trees ----------------------------------------------------------------

def tree_nodes(df: DataFrame, tree: str, children: Callable[[Column], Column], name: Callable[[Column], Column],
               depth: int | None = None, out: str = "nodes") -> DataFrame:
    """Adds the list of all nodes of each row's tree, parents before children.

    Each node is ``struct(pos, depth, path, node)``: ``pos`` sorts in depth-first order,
    ``path`` holds the names from the top. A tree may start as one node or as a list of
    nodes. All levels are lists inside the row, so walking needs no shuffle and no
    recursion; the number of levels is ``depth``, or is measured first when not given.
    A tree deeper than ``depth`` fails the job rather than losing nodes.
    """
    def child_structs(parent: Column) -> Column:
        return F.transform(children(parent["node"]), lambda c, i: F.struct(
            F.concat(parent["pos"], F.lit("."), F.lpad(i.cast("string"), 9, "0")).alias("pos"),
            (parent["depth"] + 1).alias("depth"),
            F.concat(parent["path"], F.array(F.coalesce(name(c), F.lit("")))).alias("path"),
            c.alias("node")))

    if depth is None:
        depth = _tree_depth(df, tree, children)
    roots = F.coalesce(F.try_variant_get(tree, "$", "array<variant>"), F.array(F.col(tree)))
    levelled = df.withColumn("_level0", F.transform(roots, lambda r, i: F.struct(
        F.lpad(i.cast("string"), 9, "0").alias("pos"), F.lit(0).alias("depth"),
        F.array(F.coalesce(name(r), F.lit(""))).alias("path"), r.alias("node"))))
    for d in range(1, depth + 2):
        levelled = levelled.withColumn(f"_level{d}", F.flatten(F.transform(
            f"_level{d - 1}", lambda p: F.coalesce(child_structs(p), F.array()))))
    below = F.size(f"_level{depth + 1}") > 0
    every = F.concat(*[F.col(f"_level{d}") for d in range(depth + 1)])
    guarded = F.when(below, F.raise_error(F.lit(f"tree deeper than {depth} levels")).cast("string"))
    return levelled.select(*df.columns, F.when(guarded.isNull(), every).alias(out))


def _tree_depth(df: DataFrame, tree: str, children: Callable[[Column], Column], step: int = 6) -> int:
    """Largest number of levels below the top over all rows; one scan per ``step`` levels."""
    roots = F.coalesce(F.try_variant_get(tree, "$", "array<variant>"), F.array(F.col(tree)))
    level, deepest, start = df.select(roots.alias("l0")), 0, 0
    while True:
        for d in range(start + 1, start + step + 1):
            level = level.withColumn(f"l{d}", F.flatten(F.transform(
                f"l{d - 1}", lambda n: F.coalesce(children(n), F.array()))))
        found = level.agg(F.max(F.greatest(*[
            F.when(F.size(f"l{d}") > 0, F.lit(d)).otherwise(F.lit(0)) for d in range(start + 1, start + step + 1)
        ], F.lit(0)))).first()[0] or 0
        deepest = max(deepest, found)
        if found < start + step:
            return deepest
        start += step


def leaf_files(df: DataFrame, ids: Sequence[str], tree: str, depth: int | None = None) -> DataFrame:
    """Leaf rows (path, name, size, type) of file trees; a node with a ``files`` field is a folder.

    The type is the node's own, else the text after the last dot of its name.
    """
    walked = tree_nodes(df, tree, lambda n: items_of(n, "$.files"), lambda n: pick(n, "$.name"), depth)
    rows = struct_rows(walked, ids, F.col("nodes"), ["path", "node"])
    is_leaf = F.try_variant_get("node", "$.files", "variant").isNull()
    own_name = F.coalesce(pick(F.col("node"), "$.name"), F.lit(""))
    suffix = F.when(F.contains(own_name, F.lit(".")), F.substring_index(own_name, ".", -1))
    return rows.filter(is_leaf).select(
        *ids,
        F.ltrim(F.array_join("path", "/"), F.lit("/")).alias("path"),
        own_name.alias("name"),
        pick(F.col("node"), "$.size", "bigint").alias("size"),
        F.coalesce(F.nullif(pick(F.col("node"), "$.type"), F.lit("")), suffix).alias("type"))


def section_outline(df: DataFrame, ids: Sequence[str], tree: str, depth: int | None = None) -> DataFrame:
    """Outline rows of section trees: order, depth, type, accession and numbers of parts."""
    walked = tree_nodes(df, tree, lambda n: items_of(n, "$.subsections"), lambda n: pick(n, "$.accno"), depth)
    node = F.col("node")
    return struct_rows(walked, ids, F.col("nodes"), ["pos", "depth", "node"]).select(
        *ids, "pos", "depth",
        pick(node, "$.type").alias("type"),
        F.coalesce(pick(node, "$.accno"), F.lit("")).alias("accno"),
        list_size(items_of(node, "$.attributes")).alias("n_attributes"),
        list_size(items_of(node, "$.links")).alias("n_links"),
        list_size(items_of(node, "$.files")).alias("n_files"))


def find_attribute(df: DataFrame, tree: str, name: str, out: str, depth: int | None = None) -> DataFrame:
    """First value of an attribute in depth-first order, names compared without case.

    A node's own attributes come first, then its ``section``, then its ``subsections``.
    """
    def below(n: Column) -> Column:
        section = F.try_variant_get(n, "$.section", "variant")
        return F.concat(F.when(section.isNotNull(), F.array(section)).otherwise(F.array()),
                        F.coalesce(items_of(n, "$.subsections"), F.array()))

    walked = tree_nodes(df, tree, below, lambda n: pick(n, "$.accno"), depth, out="_nodes")
    hits = F.flatten(F.transform("_nodes", lambda n: F.transform(
        F.filter(F.coalesce(items_of(n["node"], "$.attributes"), F.array()),
                 lambda a: (F.lower(pick(a, "$.name")) == name.lower()) & (F.coalesce(pick(a, "$.value"), F.lit("")) != "")),
        lambda a, i: F.struct(n["pos"].alias("pos"), i.alias("i"), pick(a, "$.value").alias("value")))))
    return walked.select(*df.columns, F.array_min(hits)["value"].alias(out))


# ---- matrices -------------------------------------------------------------

# Fixed value: row order of a nucleotide matrix.
BASES = ("A", "C", "G", "T")


def matrix_problem(lists: Sequence[Column], names: Sequence[str] = BASES) -> Column:
    """Null for a well-formed matrix, else what is wrong with it."""
    missing = F.array_join(F.filter(F.array(*[F.when(c.isNull(), F.lit(n)) for c, n in zip(lists, names)]),
                                    lambda v: v.isNotNull()), ",")
    sizes = [F.size(c) for c in lists]
    ragged = sizes[0] != sizes[1]
    for s in sizes[2:]:
        ragged = ragged | (sizes[0] != s)
    return F.when(missing != "", F.concat(F.lit("missing bases: "), missing)).when(ragged, F.lit("unequal lengths"))


def matrix_long(df: DataFrame, ids: Sequence[str], lists: Mapping[str, str] | None = None, strict: bool = False) -> DataFrame:
    """Base-keyed lists as (ids, pos, base, n) rows, positions from 0, in the fixed base order.

    A malformed matrix is left out (see :func:`matrix_problem`), or fails the job in strict mode.
    """
    lists = lists or {b: b for b in BASES}
    problem = matrix_problem([F.col(c) for c in lists.values()], list(lists))
    if strict:
        df = df.filter(F.when(problem.isNull(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean")))
    else:
        df = df.filter(problem.isNull())
    columns = df.select(*ids, F.posexplode(F.arrays_zip(*[F.col(c).alias(b) for b, c in lists.items()])).alias("pos", "_m"))
    return columns.select(*ids, "pos", F.inline(F.array(*[
        F.struct(F.lit(b).alias("base"), F.col(f"_m.{b}").cast("double").alias("n")) for b in lists])))


def rank_columns(hierarchy: Column, keys: Mapping[str, str]) -> list[Column]:
    """One column per level of a VARIANT hierarchy map; ``keys`` maps the raw key to a safe name."""
    return [F.try_variant_get(hierarchy, f"$['{raw}']", "string").alias(safe) for raw, safe in keys.items()]


# Raw level names of a taxonomy hierarchy and their column names.
TAXON_LEVELS = {
    "super kingdom": "superkingdom",
    "kingdom": "kingdom",
    "phylum": "phylum",
    "class": "class_",
    "order": "order",
    "family": "family",
    "genus": "genus",
    "species": "species",
}


def declared(schema: str | T.StructType, text: Column) -> Column:
    """JSON text as a struct of the declared shape: listed fields kept, absent ones null."""
    return F.from_json(text, schema)
