"""Tests between groups from sufficient statistics, which merge: one partial row per task and group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions import special
from tabularium.session import stored

#: Newton steps after which a regression fails instead of coming out unfinished.
MAX_ROUNDS = 50


def _number(column: str) -> Column:
    """The value as a double; NaN counts as missing."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def welch(df: DataFrame, group: str, first: object, second: object, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Welch's t test of two groups: (by..., n1, n2, mean1, mean2, t, dof, p), one row per by, from one aggregate.

    Missing and NaN values are left out. t, dof and p are null where a group has less than two values or both have no spread.
    """
    one, two = (F.when(F.col(group) == F.lit(g), _number(value)) for g in (first, second))
    wide = df.groupBy(*by).agg(F.count(one).alias("n1"), F.count(two).alias("n2"), F.avg(one).alias("mean1"), F.avg(two).alias("mean2"),
                               F.var_samp(one).alias("_v1"), F.var_samp(two).alias("_v2"))
    a, b = F.col("_v1") / F.col("n1"), F.col("_v2") / F.col("n2")
    enough = (F.col("n1") > 1) & (F.col("n2") > 1) & (F.col("_v1") + F.col("_v2") > 0)
    t = F.when(enough, (F.col("mean1") - F.col("mean2")) / F.sqrt(a + b))
    dof = F.when(enough, (a + b) * (a + b) / (a * a / (F.col("n1") - 1) + b * b / (F.col("n2") - 1)))
    return wide.select(*by, "n1", "n2", "mean1", "mean2", t.alias("t"), dof.alias("dof")).withColumn("p", special.t_two_sided(F.col("t"), F.col("dof")))


def chi_squared(df: DataFrame, rows: str, columns: str, by: Sequence[str] = ()) -> DataFrame:
    """Chi-squared test of independence: (by..., n, chi2, dof, p, cramers_v); rows with a null in either column are left out.

    The table of counts is made by partial counts and only its filled cells are kept: the statistic is n times the sum of
    squared counts over the products of their margins, minus n, so empty cells need no row. p is null for one row or column.
    """
    by = list(by)
    cells = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull()).groupBy(*by, F.col(rows).alias("_r"), F.col(columns).alias("_c")).agg(F.count("*").alias("_n"))
    across, down = (F.sum("_n").over(Window.partitionBy(*by, c)) for c in ("_r", "_c"))
    parts = cells.select(*by, "_r", "_c", "_n", (F.col("_n").cast("double") * F.col("_n") / (across * down.cast("double"))).alias("_x"))
    wide = parts.groupBy(*by).agg(F.sum("_n").alias("n"), F.sum("_x").alias("_x"), F.count_distinct("_r").alias("_rows"), F.count_distinct("_c").alias("_columns"))
    chi2 = F.greatest(F.lit(0.0), F.col("n") * (F.col("_x") - 1))
    dof = (F.col("_rows") - 1) * (F.col("_columns") - 1)
    less = F.least("_rows", "_columns") - 1
    found = wide.where("n > 0").select(*by, "n", chi2.alias("chi2"), dof.alias("dof"), F.sqrt(F.try_divide(chi2, F.col("n") * less)).alias("cramers_v"))
    return found.select(*by, "n", "chi2", "dof", F.when(F.col("dof") > 0, special.chi_squared_tail(F.col("chi2"), F.col("dof"))).alias("p"), "cramers_v")


def fisher(df: DataFrame, first: Column, second: Column, by: Sequence[str] = ()) -> DataFrame:
    """Fisher's exact test of two conditions: (by..., both, first_only, second_only, neither, odds_ratio, p).

    Rows where a condition is null are left out. The odds ratio is null where it divides by zero.
    """
    counts = df.where(first.isNotNull() & second.isNotNull()).groupBy(*by).agg(
        F.count_if(first & second).alias("both"), F.count_if(first & ~second).alias("first_only"),
        F.count_if(~first & second).alias("second_only"), F.count_if(~first & ~second).alias("neither"))
    a, b, c, d = (F.col(x) for x in ("both", "first_only", "second_only", "neither"))
    return counts.withColumn("odds_ratio", F.try_divide(a.cast("double") * d, b.cast("double") * c)).withColumn("p", special.fisher_two_sided(a, b, c, d))


def poisson_regression(df: DataFrame, count: str, terms: Mapping[str, Column], exposure: Column | None = None, tolerance: float = 1e-10) -> DataFrame:
    """Poisson regression with log link: (term, estimate, std_error, z, p, rate_ratio), the intercept first.

    Iterated weighted least squares: every round adds up the gradient and the information matrix in the tasks, and k + k * k
    sums for k terms reach the driver, which solves for the step. Rows with a null or NaN in a count, term or exposure, or
    without exposure, are left out. It is a ValueError if no row counts anything or terms depend on each other, and a
    RuntimeError if the steps do not settle.
    """
    names = ["intercept", *terms]
    x = [F.lit(1.0), *[c.cast("double") for c in terms.values()]]
    offset = F.log(exposure.cast("double")) if exposure is not None else F.lit(0.0)
    rows = df.select(F.col(count).cast("double").alias("y"), offset.alias("o"), F.array(*x).alias("x"))
    rows = rows.where("y IS NOT NULL AND NOT isnan(y) AND o IS NOT NULL AND NOT isnan(o) AND o > double('-infinity') AND forall(x, v -> v IS NOT NULL AND NOT isnan(v))")
    # Equal rows count once with their number, which folds categories to a few rows.
    rows = stored(rows.groupBy("o", "x").agg(F.sum("y").alias("y"), F.count("*").alias("n")), "regression-rows")
    k = len(x)
    total, weight = rows.agg(F.sum("y"), F.sum(F.col("n") * F.exp("o"))).first()
    if not total:
        raise ValueError("no counts to fit")
    beta = np.zeros(k)
    beta[0] = np.log(total / weight)
    for _ in range(MAX_ROUNDS):
        eta = F.col("o")
        for i in range(k):
            eta = eta + F.lit(float(beta[i])) * F.col("x")[i]
        fitted = rows.select("x", "y", (F.col("n") * F.exp(eta)).alias("mu"))
        score = [F.sum((F.col("y") - F.col("mu")) * F.col("x")[i]) for i in range(k)]
        places = [(i, j) for i in range(k) for j in range(i + 1)]
        flat = fitted.agg(*score, *[F.sum(F.col("mu") * F.col("x")[i] * F.col("x")[j]) for i, j in places]).first()
        gradient, information = np.array(flat[:k]), np.zeros((k, k))
        for (i, j), v in zip(places, flat[k:], strict=True):
            information[i, j] = information[j, i] = v
        if np.linalg.cond(information) > 1e14:
            raise ValueError("terms depend on each other")
        step = np.linalg.solve(information, gradient)
        beta += step
        if np.abs(step).max() <= tolerance * (1 + np.abs(beta).max()):
            break
    else:
        raise RuntimeError("the regression did not settle")
    errors = np.sqrt(np.diag(np.linalg.inv(information)))
    out = df.sparkSession.createDataFrame([(n, float(b), float(e)) for n, b, e in zip(names, beta, errors, strict=True)], "term string, estimate double, std_error double")
    z = F.col("estimate") / F.col("std_error")
    return out.select("*", z.alias("z")).select("*", special.normal_two_sided(F.col("z")).alias("p"), F.exp("estimate").alias("rate_ratio"))
