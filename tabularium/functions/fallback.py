"""Fallback between alternative fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_present(*cols: Column) -> Column:
    """First value that is not null; ``0``, ``''`` and ``false`` count as values."""
    return F.coalesce(*cols)


def first_truthy(*cols: Column, kind: str = "text") -> Column:
    """First value that is neither null nor empty.

    ``kind`` says what empty means: ``text`` skips ``''``, ``number`` skips ``0``, ``flag``
    skips ``false`` and ``list`` skips lists without items. A measured zero is skipped too,
    so use :func:`first_present` where zero is a reading.
    """
    empty = {"text": F.lit(""), "number": F.lit(0), "flag": F.lit(False)}
    if kind == "list":
        return F.coalesce(*[F.when(F.size(c) > 0, c) for c in cols])
    return F.coalesce(*[F.nullif(c, empty[kind]) for c in cols])
