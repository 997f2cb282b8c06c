"""Rank correlation with average ranks of ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.operators.indexing import running_total
from tabularium.session import stored, tasks_for


def average_ranks(counts: DataFrame, keys: Sequence[str], value: str, count: str, out: str, tasks: int | None = None) -> DataFrame:
    """Distinct values per key with their counts, and the mean of the ranks (from 1) that their rows take.

    The running count of a range-partitioned sort is the last of a value's ranks, so ties that would lie on both sides of a
    partition border are one row here, however many there are.
    """
    ranked = running_total(counts, keys, [value], count, "_upto", tasks)
    return ranked.withColumn(out, F.col("_upto") - (F.col(count) - 1) / 2).drop("_upto")


def spearman(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Rank correlation of every pair of columns, per group: (by..., a, b, n, rho) with a before b in the order given.

    A pair uses the rows where both values are there and not NaN, and ranks them among these. All pairs go through one scan:
    rows are counted per (group, pair, x, y), a partial count that folds hot values, and written; ranks come from the counts
    of the distinct values, and the correlation from weighted sums of centred ranks. A column is ranked once for all pairs
    in which no row with its value lacks the other. rho is null where a side has one value only.
    """
    by, pairs = list(by), [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    keys = [f"_g{i}" for i in range(len(by))]
    named = [F.col(k).alias(n) for k, n in zip(by, keys, strict=True)]
    values = [F.col(c).cast("double") + F.lit(0.0) for c in columns]  # -0.0 ties with 0.0
    entries = F.array(*[F.struct(F.lit(k).alias("pair"), values[i].alias("x"), values[j].alias("y")) for k, (i, j) in enumerate(pairs)])
    usable = [v.isNotNull() & ~F.isnan(v) for v in values]
    # Rows that have a column and lack another; where there are none, all rows of the column are in the pair.
    one_sided = [F.coalesce(F.sum((usable[i] & ~usable[j]).cast("int")), F.lit(0)) for p in pairs for i, j in (p, p[::-1])]
    lacking = df.agg(*one_sided).first() if pairs else ()
    ranked_as, first = {}, {}  # (pair, side) -> the (pair, side) whose ranks it has
    for k, p in enumerate(pairs):
        for side in (0, 1):
            entry = k, side
            ranked_as[entry] = entry if lacking[2 * k + side] else first.setdefault(p[side], entry)
    spark = df.sparkSession
    long = df.select(*named, F.explode(entries).alias("e")).select(*keys, "e.*")
    counted = long.where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)").groupBy(*keys, "pair", "x", "y").agg(F.count("*").alias("n"))
    cells = stored(counted, "cells")
    group = [*keys, "pair"]
    sides = [F.struct(F.lit(0).alias("side"), F.col("x").alias("v")), F.struct(F.lit(1).alias("side"), F.col("y").alias("v"))]
    made = F.array(*[F.when(F.col("pair").isin([k for k, s in set(ranked_as.values()) if s == side]), e) for side, e in enumerate(sides)])
    both = cells.select(*group, "n", F.explode(made).alias("e")).where("e IS NOT NULL")
    counts = stored(both.select(*group, "n", "e.*").groupBy(*group, "side", "v").agg(F.sum("n").alias("n")), "value-counts")
    ranked = stored(average_ranks(counts, [*group, "side"], "v", "n", "rank", tasks_for(spark, counts.count())), "ranks")
    totals = stored(cells.groupBy(*group).agg(F.sum("n").alias("_all")), "totals")

    def beside(rows: DataFrame, other: DataFrame, on: dict[str, Column], out: str, name: str) -> DataFrame:
        """Rows with one column of another table, joined on the group, null-safe, and the given columns."""
        right = other.select(*[F.col(k).alias(f"{k}_of") for k in keys], *[F.col(c).alias(f"{c}_of") for c in on], F.col(out).alias(name))
        match = F.lit(True)
        for k in keys:
            match = match & F.col(k).eqNullSafe(F.col(f"{k}_of"))
        for c, v in on.items():
            match = match & (v == F.col(f"{c}_of"))
        return rows.join(right, match).drop(*[f"{c}_of" for c in [*keys, *on]])

    placed = cells
    for side, value, name in ((0, "x", "_rx"), (1, "y", "_ry")):
        as_pair, as_side = (F.element_at(F.array(*[F.lit(ranked_as[k, side][at]) for k in range(len(pairs))]), F.col("pair") + 1) for at in (0, 1))
        placed = beside(placed, ranked, {"pair": as_pair, "side": as_side, "v": F.col(value)}, "rank", name)
    placed = beside(placed, totals, {"pair": F.col("pair")}, "_all", "_all")
    middle = (F.col("_all") + 1) / 2
    dx, dy, n = F.col("_rx") - middle, F.col("_ry") - middle, F.col("n")
    sums = placed.groupBy(*group).agg(F.sum(n).alias("n"), F.sum(n * dx * dy).alias("xy"), F.sum(n * dx * dx).alias("xx"), F.sum(n * dy * dy).alias("yy"))
    rho = F.try_divide(F.col("xy"), F.sqrt("xx") * F.sqrt("yy"))
    left, right = (F.element_at(F.array(*[F.lit(columns[p[side]]) for p in pairs]), F.col("pair") + 1) for side in (0, 1))
    return sums.select(*[F.col(n).alias(k) for k, n in zip(by, keys, strict=True)], left.alias("a"), right.alias("b"), "n",
                       F.round(F.when(rho > 1, 1.0).when(rho < -1, -1.0).otherwise(rho), digits).alias("rho"))
