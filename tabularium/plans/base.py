"""What a declared table is: a raw shape, an envelope and the expressions of its columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.names import normalise_names
from tabularium.functions.rows import item_rows
from tabularium.sources.delimited import null_tokens, parse_lines, read_table
from tabularium.sources.landed import page_fault, read_pages, refuse, rejected_pages

Columns = Callable[[Column, Column], dict[str, Column]]


def _shared_shapes(paths: Sequence[str], inner: str) -> list[tuple[str, list[str]]]:
    """Struct DDLs that cover dotted paths, each with the paths it covers.

    Paths share one shape, so one parse, unless one is a prefix of another.
    """
    groups: list[list[str]] = []
    for path in paths:
        for group in groups:
            if not any(p == path or p.startswith(path + ".") or path.startswith(p + ".") for p in group):
                group.append(path)
                break
        else:
            groups.append([path])

    def ddl(steps: list[list[str]]) -> str:
        heads = list(dict.fromkeys(s[0] for s in steps))
        fields = []
        for head in heads:
            rest = [s[1:] for s in steps if s[0] == head]
            fields.append(f"`{head}`: {inner if rest == [[]] else ddl(rest)}")
        return f"struct<{', '.join(fields)}>"

    return [(ddl([p.split(".") for p in group]), group) for group in groups]


#: Leaves that are read as text first and cast after, so that a number sent as text keeps its value.
_TYPED = re.compile(r"\b(bigint|int|double|boolean)\b(?=\s*(?:[,>]|$))")


def _record_fault(record: str) -> Column:
    """Why a text is no record: it cannot be read, or it is not an object."""
    return (F.when(F.try_parse_json(record).isNull(), "unreadable")
             .when(~F.ltrim(record).startswith("{"), "wrong shape"))


@dataclass(frozen=True)
class JsonTable:
    """Table from JSON records.

    ``record`` is the DDL of the fields that are read. Every leaf is read as text; those that
    declare a number or a boolean are then cast, so ``"97.5"`` counts as 97.5 and a value of
    another type becomes null instead of losing its record.
    ``envelope`` lists the dotted paths where a page keeps its records (``$`` for a bare list).
    ``items`` gives the child list of a record for tables with one row per child; records
    without children give no row, or one with null children when ``keep_parents``.
    ``columns`` maps the record and the child to the output columns.
    """

    name: str
    record: str
    columns: Columns
    envelope: tuple[str, ...] = ("$",)
    items: Callable[[Column], Column] | None = None
    keep_parents: bool = False

    def _paths(self) -> list[str]:
        return [p if p == "$" else f"$.{p}" for p in self.envelope]

    def rejected_pages(self, df: DataFrame, page: str = "page", keep: Sequence[str] = ()) -> DataFrame:
        """Pages that cannot be read or have none of the envelopes, with the reason."""
        return rejected_pages(df, page, self._paths(), keep)

    def rejected_records(self, df: DataFrame, record: str = "record", keep: Sequence[str] = ()) -> DataFrame:
        """Records that cannot be read or are no object, with the reason."""
        return df.select(*keep, _record_fault(record).alias("reason")).where(F.col("reason").isNotNull())

    def from_pages(self, df: DataFrame, page: str = "page", keep: Sequence[str] = (), strict: bool = False) -> DataFrame:
        """Rows of all records of all pages. The first envelope path with records counts.

        Pages that ``rejected_pages`` lists give no rows; with ``strict`` they fail the job.
        """
        if strict:
            df = refuse(df, page_fault(F.try_parse_json(page), self._paths()))
        shape = f"array<struct<{self._text_record}>>"
        text, parsed, found = F.col(page), {}, {}
        if "$" in self.envelope:
            parsed["_p"] = F.from_json(F.when(F.ltrim(text).startswith("["), text), shape)
            found["$"] = F.col("_p")
        for i, (ddl, paths) in enumerate(_shared_shapes([p for p in self.envelope if p != "$"], shape)):
            parsed[f"_p{i}"] = F.from_json(text, ddl)
            found.update({p: F.col(".".join(f"`{s}`" for s in [f"_p{i}", *p.split(".")])) for p in paths})
        lists = [found[p] for p in self.envelope]
        records = lists[0] if len(lists) == 1 else F.get(F.filter(F.array(*lists), lambda a: F.size(a) > 0), F.lit(0))
        pages = df.select(*keep, *[c.alias(n) for n, c in parsed.items()])
        return self._rows(item_rows(pages, keep, records, "_r"), keep)

    def from_records(self, df: DataFrame, record: str = "record", keep: Sequence[str] = (), strict: bool = False) -> DataFrame:
        """Rows of records that are in a column, one JSON object each.

        Those that ``rejected_records`` lists give no rows; with ``strict`` they fail the job.
        """
        fault, parsed = _record_fault(record), F.from_json(record, f"struct<{self._text_record}>")
        if strict:
            return self._rows(refuse(df, fault).select(*keep, parsed.alias("_r")), keep)
        # Not a filter: that would move below what makes the records, which would then be made for each use.
        found = df.select(*keep, F.explode_outer(F.when(fault.isNull(), F.array(F.struct(parsed.alias("_r"))))).alias("_x"))
        return self._rows(found.where(F.col("_x").isNotNull()).select(*keep, F.col("_x._r").alias("_r")), keep)

    def read(self, spark: SparkSession, path: str | list[str], strict: bool = False) -> DataFrame:
        """Rows of landed page files."""
        return self.from_pages(read_pages(spark, path), strict=strict)

    @property
    def _text_record(self) -> str:
        return _TYPED.sub("string", self.record)

    def _rows(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        if self._text_record != self.record:
            df = df.select(*keep, F.col("_r").try_cast(f"struct<{self.record}>").alias("_r"))
        if self.items is None:
            df = df.withColumn("_x", F.lit(None))
        else:
            df = df.select(*keep, "_r", F.explode_outer(self.items(F.col("_r"))).alias("_x"))
            if not self.keep_parents:
                df = df.filter(F.col("_x").isNotNull())
        cols = self.columns(F.col("_r"), F.col("_x"))
        return df.select(*keep, *[c.alias(n) for n, c in cols.items()])


@dataclass(frozen=True)
class TextTable:
    """Table from delimited text: column types in file order, layout options and a finishing step."""

    name: str
    schema: str
    sep: str = "\t"
    header: bool = True
    comment: str | None = None
    quote: str | None = None
    null_values: tuple[str, ...] = ()
    style: str | None = None
    finish: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)

    def _done(self, df: DataFrame) -> DataFrame:
        return self.finish(normalise_names(df, self.style) if self.style else df)

    def read(self, spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
        """Rows of landed files, plain or gzip."""
        return self._done(read_table(spark, path, self.schema, self.sep, self.header, self.comment, self.quote,
                                     self.null_values, partitions))

    def from_lines(self, df: DataFrame, line: str) -> DataFrame:
        """Rows of lines that are in a column (no header among them)."""
        if self.comment:
            df = df.filter(~F.col(line).startswith(self.comment))
        rows = parse_lines(df, line, self.schema, self.sep, self.quote)
        return self._done(null_tokens(rows, self.null_values) if self.null_values else rows)
