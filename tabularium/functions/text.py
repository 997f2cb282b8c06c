"""Text, regular-expression and small numeric expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.rows import struct_rows


def _literal_pattern(text: str) -> str:
    return "\\Q" + text + "\\E"


def after_first(c: Column, sep: str) -> Column:
    """Text after the first separator; text without one is returned unchanged."""
    return F.coalesce(F.get(F.split(c, _literal_pattern(sep), 2), F.lit(1)), c)


def before_first(c: Column, sep: str) -> Column:
    """Text before the first separator; all of it where there is none."""
    return F.substring_index(c, sep, 1)


def split_once(c: Column, sep: str, left: str, right: str) -> Column:
    """Struct of the texts before and after the first separator (right is null without one)."""
    parts = F.split(c, _literal_pattern(sep), 2)
    return F.struct(F.get(parts, F.lit(0)).alias(left), F.get(parts, F.lit(1)).alias(right))


def dotted_levels(c: Column, names: Sequence[str]) -> list[Column]:
    """Dotted code as whole-number columns.

    A missing level is 0 (also for missing or empty text), a level that is not all digits is null.
    """
    parts = F.split(F.when(c != "", c), "\\.")
    out = []
    for i, name in enumerate(names):
        part = F.coalesce(F.get(parts, F.lit(i)), F.lit("0"))
        out.append(F.when(part.rlike("^[0-9]+$"), part.try_cast("int")).alias(name))
    return out


def equation_participants(c: Column) -> Column:
    """Distinct names left of ``=`` in ``A + B = C``, in first-seen order; null without ``=``."""
    names = F.transform(F.split(F.substring_index(c, "=", 1), " \\+ "), lambda s: F.trim(s))
    return F.when(F.contains(c, F.lit("=")), F.array_distinct(F.filter(names, lambda n: n != "")))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, null when nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def match_structs(c: Column, pattern: str, groups: Mapping[str, int], unknown: Mapping[str, str] | None = None) -> Column:
    """All matches as an array of structs, one field per named group.

    A group that took no part in a match is null, or its entry in ``unknown``.
    """
    unknown = unknown or {}
    names = list(groups)
    zipped = F.arrays_zip(*[
        F.regexp_extract_all(c, F.lit(pattern), F.lit(index)).alias(name) for name, index in groups.items()
    ])

    def clean(match: Column) -> Column:
        fields = []
        for name in names:
            value = F.nullif(F.trim(match[name]), F.lit(""))
            if name in unknown:
                value = F.coalesce(value, F.lit(unknown[name]))
            fields.append(value.alias(name))
        return F.struct(*fields)

    return F.transform(zipped, clean)


def match_rows(df: DataFrame, c: Column, pattern: str, groups: Mapping[str, int],
               unknown: Mapping[str, str] | None = None) -> DataFrame:
    """One row per match with one column per named group."""
    return struct_rows(df, df.columns, match_structs(c, pattern, groups, unknown), list(groups))


def stated_quantity(name: str, units: Sequence[str], of: str | None = None) -> str:
    """Pattern of ``name = number unit`` in prose: group 1 the number as written, group 2 the unit.

    The name is read in any case. With ``of``, group 3 is what follows that word up to a stop
    (a bracket, comma, full stop or semicolon), and the statement as a whole must run up to a
    comma, full stop, semicolon or the end of the text.
    """
    unit = "|".join(sorted(map(re.escape, units), key=len, reverse=True))
    head = f"(?i:{re.escape(name)})\\s*=\\s*([0-9.]+)\\s*({unit})"
    if of is None:
        return head
    return head + f"(?:\\s+{re.escape(of)}\\s+([^(,.;]*[^(,.;\\s]))?(?=\\s*(?:[,.;]|$))"


# Fixed value: an archive accession is a letter prefix and a number.
ACCESSION = "^(S-[A-Z]+)([0-9]+)"


def accession_path(c: Column, strict: bool = False) -> Column:
    """Storage path ``prefix/last three digits/accession/Files`` of an archive accession.

    A short number is zero-padded to three digits. A malformed accession is null, or fails
    the job in strict mode.
    """
    digits = extract(c, ACCESSION, 2)
    folder = F.right(F.concat(F.lit("00"), digits), F.lit(3))
    path = F.concat(extract(c, ACCESSION, 1), F.lit("/"), folder, F.lit("/"), c, F.lit("/Files"))
    if strict:
        return F.coalesce(path, F.raise_error(F.concat(F.lit("invalid accession: "), F.coalesce(c, F.lit("null")))).cast("string"))
    return path


def next_link(header: Column) -> Column:
    """Next-page address in a ``Link`` header, null on the last page.

    A header holds targets in angle brackets, each with parameters in any order; ``rel`` may
    be quoted, list several relations, and come after other parameters.
    """
    links = F.regexp_extract_all(header, F.lit("<[^>]*>[^<]*"), F.lit(0))
    relation = '(?i);\\s*rel\\s*=\\s*(?:"(?:[^"]*\\s)?next(?:\\s[^"]*)?"|next\\s*(?:[;,]|$))'
    found = F.get(F.filter(links, lambda link: link.rlike(relation)), F.lit(0))
    return F.nullif(F.substring_index(F.substring_index(found, ">", 1), "<", -1), F.lit(""))


def fixed_part(c: Column, start: int, length: int) -> Column:
    """Characters at a fixed place (1-based), null when the text is too short."""
    return F.when(F.length(c) >= start + length - 1, F.substring(c, start, length))


def joined_name(*parts: Column) -> Column:
    """Parts with one blank between them, null when nothing is left."""
    return F.nullif(F.trim(F.concat_ws(" ", *parts)), F.lit(""))


def preview(c: Column, limit: int = 80) -> Column:
    """Text shortened for display, marked with an ellipsis when shortened."""
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit("…"))).otherwise(c)


def relation_parts(line: Column) -> tuple[Column, Column]:
    """Relation type and target of ``type target ! label``; null for a line of another form."""
    pattern = "^(\\S+) (\\S+)"
    return extract(line, pattern, 1), extract(line, pattern, 2)


def lineage(given: Column, parts: Sequence[Column]) -> Column:
    """The given lineage where there is one, else the parts joined by semicolons (gaps kept)."""
    own = F.concat_ws(";", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.coalesce(F.nullif(given, F.lit("")), own)


def extension(name: Column, default: str | None = "(none)") -> Column:
    """Lower-case suffix with its dot; a leading or trailing dot starts none."""
    found = extract(F.lower(name), "^.+(\\.[^.]+)$", 1)
    return found if default is None else F.coalesce(found, F.lit(default))


def scaled(c: Column, factor: float, digits: int) -> Column:
    """Value divided by a factor and rounded half up."""
    return F.round(c / F.lit(factor), digits)


def span_length(start: Column, stop: Column) -> Column:
    """Length of a closed interval."""
    return stop - start + F.lit(1)
