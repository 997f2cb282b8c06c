"""Corrections of p-values for many tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.session import cut_lineage, stored, tasks_for

#: Tests that a task sorts and numbers.
TASK_TESTS = 250_000


def adjust(df: DataFrame, p: str, by: Sequence[str] = ()) -> DataFrame:
    """df with p_bonferroni, p_holm, p_bh (Benjamini-Hochberg) and p_by (Benjamini-Yekutieli), each family of tests by itself.

    With m tests and rank j of the ascending p-values: p * m; the running maximum of p * (m - j + 1); the running minimum from
    the largest p down of p * m / j, which for p_by is also multiplied by the harmonic number of m. None exceeds 1. Equal
    p-values get equal results. A p that is null or NaN is no test and gets nulls; null is a family.

    A range-partitioned sort puts the tests of a family over many tasks, also those of one p-value, as many as the rows need. Ranks and running extremes
    come from the rows of a partition and one row of totals per partition and family. The sorted table is checkpointed, as
    all of it must see the same partitions. Columns of the four names are replaced.
    """
    by, out = list(by), ["p_bonferroni", "p_holm", "p_bh", "p_by"]
    kept = [c for c in df.columns if c.lower() not in out]
    usable = F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double"))
    tests = df.where(usable).select(*kept, F.col(p).cast("double").alias("_p"))
    keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(by)]
    names = [f"_k{i}" for i in range(len(by))]
    tasks, order = tasks_for(df.sparkSession, df.count(), TASK_TESTS), [*names, "_p", "_tie"]
    spread = tests.select("*", *keys, F.rand(17).alias("_tie")).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    ordered = cut_lineage(spread.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")))

    # Rows before each partition in its family, and rows of the family: one row per partition and family.
    sizes = ordered.groupBy("_part", *names).agg(F.count("*").alias("_n"))
    family = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    upward = family.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", *names, F.coalesce(F.sum("_n").over(upward), F.lit(0)).alias("_before"), F.sum("_n").over(family).alias("_m"))
    # Totals are written, so that few of them are copied to the rows and the rows are not shuffled to them.
    sizes = stored(sizes, "family-sizes")
    inside = Window.partitionBy("_part", *names)
    numbered = _beside(ordered.repartition(tasks, "_part", *names).withColumn("_j", F.row_number().over(inside.orderBy("_row"))), sizes, names)
    numbered = numbered.withColumn("_j", F.col("_j") + F.col("_before"))
    scaled = numbered.select("*", (F.col("_p") * F.col("_m") / F.col("_j")).alias("_down"), (F.col("_p") * (F.col("_m") - F.col("_j") + 1)).alias("_up"))

    # Running extremes: over the later partitions for the minimum, over the earlier ones for the maximum. Of equal p-values
    # the last has the least of the first kind, and the first the greatest of the second.
    ends = scaled.groupBy("_part", *names).agg(F.min("_down").alias("_least"), F.max("_up").alias("_most"))
    # Frames start at the first row: those that end at the last would be summed anew for every row.
    later = family.orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_part", *names, F.min("_least").over(later).alias("_least"), F.max("_most").over(upward).alias("_most"))
    ends = stored(ends, "family-ends")
    low = F.min("_down").over(inside.orderBy(F.col("_row").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    high = F.max("_up").over(inside.orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = _beside(scaled.withColumns({"_low": low, "_high": high}), ends, names)
    least, most = F.least("_low", "_least"), F.greatest("_high", "_most")
    # Euler's constant and the first terms of the series give the harmonic number to double precision from 50 on.
    m = F.col("_m").cast("double")
    series = F.log(m) + 0.5772156649015329 + 1 / (2 * m) - 1 / (12 * m * m) + 1 / (120 * m * m * m * m)
    harmonic = F.when(F.col("_m") > 50, series).otherwise(F.aggregate(F.sequence(F.lit(1), F.least("_m", F.lit(50)).cast("int")), F.lit(0.0), lambda s, i: s + 1 / i))
    one = F.lit(1.0)
    done = found.select(*kept, F.least(F.col("_p") * F.col("_m"), one).alias(out[0]), F.least(most, one).alias(out[1]),
                        F.least(least, one).alias(out[2]), F.least(least * harmonic, one).alias(out[3]))
    return done.unionAll(df.where(~usable).select(*kept, *[F.lit(None).cast("double").alias(c) for c in out]))


def _beside(rows: DataFrame, totals: DataFrame, names: list[str]) -> DataFrame:
    """Rows with the totals of their partition and family."""
    named = totals.select(F.col("_part").alias("_of"), *[F.col(k).alias(f"{k}_of") for k in names],
                          *[c for c in totals.columns if c != "_part" and c not in names])
    match = F.col("_part") == F.col("_of")
    for k in names:
        match = match & F.col(k).eqNullSafe(F.col(f"{k}_of"))
    return rows.join(named, match).drop("_of", *[f"{k}_of" for k in names])
