"""One row per item of a computed list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def item_rows(df: DataFrame, keep: Sequence[str], items: Column, out: str) -> DataFrame:
    """Rows (keep..., out), one per item that is not null; a row without items gives none.

    A plain ``explode`` makes the optimizer test ``size(items) > 0`` below it, and for a list
    that is computed (parsed JSON, a walked tree, regular-expression matches) that test
    computes the list a second time. The outer form with a filter on the item does not.
    """
    return df.select(*keep, F.explode_outer(items).alias(out)).filter(F.col(out).isNotNull())


def struct_rows(df: DataFrame, keep: Sequence[str], items: Column, fields: Sequence[str]) -> DataFrame:
    """The same for structs, their fields as columns."""
    rows = item_rows(df, keep, items, "_item")
    return rows.select(*keep, *[F.col("_item")[f].alias(f) for f in fields])
