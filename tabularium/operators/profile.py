"""Table profiles: nulls, describe, dtypes. One aggregate pass per profile, not one per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators.quantiles import exact_quantiles


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one wide row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_rates(df: DataFrame, only_with_nulls: bool = False, digits: int = 1) -> DataFrame:
    """Nulls per column as (column, nulls, null_pct), the share rounded."""
    wide = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = wide.unpivot(["_rows"], df.columns, "column", "nulls").select(
        "column", "nulls", F.round(F.try_divide(F.col("nulls") * F.lit(100.0), F.col("_rows")), digits).alias("null_pct"))
    return long.filter(F.col("nulls") > 0) if only_with_nulls else long


def describe(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Count, nulls, mean, sample deviation, extremes and exact linear quartiles per column.

    Two passes over the named columns only: one for the moments, one for the quartiles.
    """
    stats = ["count", "null_count", "mean", "std", "min", "max"]
    wide = df.agg(*[F.struct(
        F.count(c).cast("double").alias("count"), F.count_if(F.col(c).isNull()).cast("double").alias("null_count"),
        F.avg(c).cast("double").alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max")).alias(c) for c in columns])
    moments = wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), *[F.col(f"{c}.{s}").alias(s) for s in stats]) for c in columns])))
    quartiles = (exact_quantiles(df, columns, [0.25, 0.5, 0.75])
                 .groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                          for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]))
    # Both sides have one row per column of the table.
    joined = moments.join(F.broadcast(quartiles), "column", "left")
    return joined.select(
        "column", F.col("count").cast("bigint").alias("count"), F.col("null_count").cast("bigint").alias("null_count"),
        *[F.round(F.col(s), digits).alias(s) for s in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows, nulls, null share, smallest and largest value as text."""
    fields = df.schema.fields
    orderable = [f.name for f in fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    wide = df.agg(F.count("*").alias("_rows"), *[F.struct(
        F.count_if(F.col(f.name).isNull()).alias("n"),
        *([F.min(f.name).cast("string").alias("lo"), F.max(f.name).cast("string").alias("hi")] if f.name in orderable
          else [F.lit(None).cast("string").alias("lo"), F.lit(None).cast("string").alias("hi")])).alias(f.name) for f in fields])
    return wide.select("_rows", F.inline(F.array(*[F.struct(
        F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
        F.col(f"`{f.name}`.n").alias("nulls"), F.col(f"`{f.name}`.lo").alias("min_text"),
        F.col(f"`{f.name}`.hi").alias("max_text")) for i, f in enumerate(fields)]))).select(
        "position", "column", "dtype", F.col("_rows").alias("n_rows"), "nulls",
        F.round(F.try_divide(F.col("nulls") * F.lit(100.0), F.col("_rows")), 1).alias("null_pct"), "min_text", "max_text")
