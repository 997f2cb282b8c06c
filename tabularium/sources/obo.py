"""Ontology text in OBO form: stanzas to edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.rows import struct_rows


def read_stanzas(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per stanza; the blank line between stanzas is the record separator.

    A file whose lines end in CR LF has no such separator and is one record, which is split here; large ones should be
    landed with plain line feeds, so that tasks can share a file.
    """
    text = F.regexp_replace("value", "\r\n?", "\n")
    parts = F.split(text, "\n[ \t]*\n")
    return (spark.read.option("lineSep", "\n\n").text(path).select(F.explode(parts).alias("stanza"))
            .where(F.trim("stanza") != ""))


def _first_line(lines: Column, prefix: str) -> Column:
    hit = F.get(F.filter(lines, lambda s: s.startswith(prefix)), F.lit(0))
    return F.substring(hit, len(prefix) + 1, 1_000_000_000)


def term_edges(df: DataFrame, stanza: str = "stanza", keep: Sequence[str] = ()) -> DataFrame:
    """Edges (child_id, child_name, parent_id, relation) of the ``[Term]`` stanzas.

    ``is_a`` lines give the relation ``is_a``, ``relationship`` lines their own type. Other
    stanza kinds are left out, so their ids never leak into a term.
    """
    lines = F.transform(F.split(F.trim(F.col(stanza)), "\n"), lambda s: F.rtrim(s))
    terms = df.select(*keep, lines.alias("_lines")).filter(F.get("_lines", F.lit(0)) == "[Term]")

    def edge(s: Column) -> Column:
        typed = s.startswith("relationship: ")
        body = F.when(typed, F.substring(s, 15, 1_000_000_000)).otherwise(F.concat(F.lit("is_a "), F.substring(s, 7, 1_000_000_000)))
        parts = F.split(body, " ")
        return F.struct(F.trim(F.get(parts, F.lit(1))).alias("parent_id"), F.get(parts, F.lit(0)).alias("relation"))

    parents = F.transform(F.filter("_lines", lambda s: s.startswith("is_a: ") | s.startswith("relationship: ")), edge)
    named = terms.select(*keep, _first_line(F.col("_lines"), "id: ").alias("child_id"),
                         F.coalesce(_first_line(F.col("_lines"), "name: "), F.lit("")).alias("child_name"),
                         parents.alias("_parents"))
    flat = struct_rows(named, [*keep, "child_id", "child_name"], F.col("_parents"), ["parent_id", "relation"])
    return flat.filter((F.col("child_id") != "") & F.col("parent_id").isNotNull())
