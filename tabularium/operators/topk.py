"""Ordering, top-k and extreme rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered(df: DataFrame, column: str, descending: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """Sorted by one column (nulls first when descending), ties by the given columns."""
    first = F.col(column).desc_nulls_first() if descending else F.col(column).asc_nulls_first()
    return df.orderBy(first, *ties)


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First n rows of an order; each task keeps n rows, nothing is sorted whole."""
    return df.orderBy(*order).limit(n)


def extreme_row(df: DataFrame, measure: str, columns: Sequence[str], largest: bool = True,
                default: dict[str, object] | None = None, ties: str | None = None) -> DataFrame:
    """The row with the largest or smallest measure (nulls left out), or the default when there is none.

    The measure is compared in its own type. Equal measures go to the smallest ``ties``; both
    steps keep one row per task. A null field of a row that exists stays null.
    """
    extreme = df.agg((F.max if largest else F.min)(measure).alias("_extreme"))
    # One row on the broadcast side.
    best = df.join(F.broadcast(extreme), F.col(measure) == F.col("_extreme"))
    picked = best.agg(F.min_by(F.struct(*columns), F.struct(F.col(ties) if ties else F.lit(0))).alias("_r"))
    fill = default or {}
    return picked.select(*[
        (F.when(F.col("_r").isNull(), F.lit(fill[c])).otherwise(F.col(f"_r.{c}")) if c in fill else F.col(f"_r.{c}")).alias(c) for c in columns])
