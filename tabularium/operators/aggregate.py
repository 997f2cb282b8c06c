"""Group counts, sums and summaries. Every measure has a map-side partial form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, *by: str, out: str = "count") -> DataFrame:
    """Rows per group (null is a group), the largest first, ties by key."""
    return df.groupBy(*by).agg(F.count("*").alias(out)).orderBy(F.col(out).desc(), *[F.col(c).asc_nulls_first() for c in by])


def group_total(df: DataFrame, by: str, measure: str, scale: float, digits: int, count_as: str = "count",
                total_as: str = "total") -> DataFrame:
    """Rows and scaled, rounded sum per group; the sum of nothing is 0."""
    return df.groupBy(by).agg(
        F.count("*").alias(count_as),
        F.round(zero_sum(measure) / F.lit(scale), digits).alias(total_as))


def zero_sum(c: str | Column) -> Column:
    """Sum that is 0, not null, for a group without values."""
    return F.coalesce(F.sum(c), F.lit(0))


def distinct_count(c: str, count_null: bool = False) -> Column:
    """Distinct values; null can count as one more value."""
    n = F.count_distinct(F.col(c))
    return n + F.coalesce(F.max(F.col(c).isNull().cast("bigint")), F.lit(0)) if count_null else n


def true_share(flag: str, out_count: str, out_pct: str, digits: int = 1) -> list[Column]:
    """Number of rows where a flag holds, and that as a percentage of all rows (null of no rows)."""
    n = F.count_if(F.col(flag))
    return [n.alias(out_count), F.round(F.try_divide(n * F.lit(100.0), F.count("*")), digits).alias(out_pct)]


def threshold_report(df: DataFrame, measure: str, threshold: float) -> DataFrame:
    """What a ``>= threshold`` filter keeps: counts, share and range of the kept values, in one pass."""
    kept = F.col(measure) >= threshold
    inside = F.when(kept, F.col(measure))
    return df.agg(
        F.count("*").alias("n_total"), F.count_if(kept).alias("n_kept"),
        (F.count("*") - F.count_if(kept)).alias("n_removed"),
        F.round(F.try_divide(F.count_if(kept).cast("double"), F.count("*")), 6).alias("fraction"),
        F.min(inside).alias("min_kept"), F.max(inside).alias("max_kept"))


def threshold_counts(df: DataFrame, measure: str, thresholds: Mapping[str, float]) -> DataFrame:
    """Rows at or above each named threshold, long form, from one pass."""
    wide = df.agg(*[F.count_if(F.col(measure) >= t).alias(n) for n, t in thresholds.items()])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("label"), F.lit(float(t)).alias("threshold"), F.col(n).alias("n_rows"))
        for n, t in thresholds.items()])))


def column_means(df: DataFrame, columns: Sequence[str], label: str = "column", out: str = "mean") -> DataFrame:
    """Mean of each column, long form, the largest first."""
    wide = df.agg(*[F.avg(c).alias(c) for c in columns])
    return wide.unpivot([], list(columns), label, out).orderBy(F.col(out).desc(), label)


def parse_outcome(df: DataFrame, error: str) -> DataFrame:
    """Rows parsed, failed and in all."""
    return df.agg(F.count("*").alias("n_total"), F.count_if(F.col(error).isNull()).alias("n_ok"),
                  F.count_if(F.col(error).isNotNull()).alias("n_failed"))


def source_counts(df: DataFrame, source: str, total_label: str = "total") -> DataFrame:
    """Rows per source and the grand total, from one roll-up."""
    return (df.rollup(source).agg(F.count("*").alias("n_rows"), F.grouping(source).alias("_all"))
              .select(F.when(F.col("_all") == 1, F.lit(total_label)).otherwise(F.col(source)).alias(source), "n_rows"))


def entity_rollup(df: DataFrame, key: str, branches: Mapping[str, Column]) -> DataFrame:
    """Distinct values per key of several branches of the same records, from one scan.

    A branch is a column: a value, or a list of them, null where the row has none. Values are compared as Spark groups them:
    0.0 and -0.0 are one, and so are NaNs. They are stacked as (key, branch, one column of its own type per branch), made
    distinct inside the tasks and again over them, which spreads a key that holds most of the rows, and then counted. Null is
    a key like others; keys without a value count 0.
    """
    shapes = [df.select(c.alias("c")).schema["c"].dataType for c in branches.values()]
    kinds = [t.elementType if t.typeName() == "array" else t for t in shapes]

    def entry(number: int, v: Column) -> Column:
        own = [(v if i == number else F.lit(None)).cast(t).alias(f"v{i}") for i, t in enumerate(kinds)]
        return F.struct(F.lit(number).alias("branch"), *own)

    # Values stand in an array as they are, null ones too, which keep their key and are not counted; lists are added to it.
    plain = F.array(*[entry(i, c) for i, c in enumerate(branches.values()) if shapes[i].typeName() != "array"])
    lists = [F.transform(F.coalesce(c, F.array().cast(shapes[i])), partial(entry, i)) for i, c in enumerate(branches.values()) if shapes[i].typeName() == "array"]
    own = [plain] if len(lists) < len(shapes) else []
    stacked = df.select(F.col(key), F.explode_outer(F.concat(*own, *lists) if lists else plain).alias("_e")).select(key, "_e.*")
    distinct = stacked.groupBy(key, "branch", *[f"v{i}" for i in range(len(kinds))]).agg(F.lit(1).alias("_one"))
    return distinct.groupBy(key).agg(*[F.count_if((F.col("branch") == i) & F.col(f"v{i}").isNotNull()).alias(out) for i, out in enumerate(branches)])
