"""Term weights, principal components and clusters of profiles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.session import stored


def tf_idf(df: DataFrame, document: str, term: str) -> DataFrame:
    """(document, term, tf, df, weight): tf * ln(documents / df), scaled to unit length per document.

    Sparse: only terms that a document holds have a row. Rows are counted by partial sums. A document whose terms are all in
    every document has weights of 0. Null documents and terms are left out.
    """
    rows = df.where(F.col(document).isNotNull() & F.col(term).isNotNull())
    counts = stored(rows.groupBy(F.col(document).alias("document"), F.col(term).alias("term")).agg(F.count("*").alias("tf")), "term-counts")
    n = counts.select("document").distinct().count()
    known = counts.groupBy("term").agg(F.count("*").alias("df"))
    weighed = counts.join(known, "term").withColumn("_w", F.col("tf") * F.log(F.lit(float(n)) / F.col("df")))
    length = weighed.groupBy("document").agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_l"))
    return weighed.join(length, "document").select("document", "term", "tf", "df", F.coalesce(F.try_divide(F.col("_w"), F.col("_l")), F.lit(0.0)).alias("weight"))


def top_terms(weights: DataFrame, n: int) -> DataFrame:
    """The n heaviest terms of each document, ties by term; only n rows per document and task are shuffled."""
    place = F.row_number().over(Window.partitionBy("document").orderBy(F.col("weight").desc(), "term"))
    return weights.withColumn("rank", place).where(F.col("rank") <= n)


def covariance(df: DataFrame, columns: Sequence[str], scale: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Means, deviations, covariance (or correlation) matrix and number of complete rows, from one partial aggregate.

    Sums are taken around a first row's values, so that large means cost no digits. Rows with a null or a number that is not
    finite are left out; a constant column has deviation 0 and stays unscaled.
    """
    k = len(columns)
    x = [F.col(c).cast("double") for c in columns]
    whole = F.lit(True)
    for c in x:
        whole = whole & c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    rows = df.where(whole).select(*[c.alias(f"x{i}") for i, c in enumerate(x)])
    first = rows.first()
    if first is None:
        return np.zeros(k), np.zeros(k), np.zeros((k, k)), 0
    d = [F.col(f"x{i}") - F.lit(first[i]) for i in range(k)]
    places = [(i, j) for i in range(k) for j in range(i + 1)]
    flat = rows.agg(F.count("*"), *[F.sum(v) for v in d], *[F.sum(d[i] * d[j]) for i, j in places]).first()
    n, sums, cov = flat[0], np.array(flat[1:k + 1]), np.zeros((k, k))
    for (i, j), v in zip(places, flat[k + 1:], strict=True):
        cov[i, j] = cov[j, i] = (v - sums[i] * sums[j] / n) / max(1, n - 1)
    deviations = np.sqrt(np.maximum(0, np.diag(cov)))
    if scale:
        by = np.where(deviations > 0, deviations, 1.0)
        cov = cov / np.outer(by, by)
    return np.array(first) + sums / n, deviations, cov, n


def principal_components(df: DataFrame, columns: Sequence[str], n: int, scale: bool = False) -> tuple[DataFrame, Column]:
    """(component, variance, share, column, loading) rows, and an array column of a row's n scores for use on df.

    The matrix of sums, the square of the number of columns, is all that reaches the driver. Loadings are signed so that the
    one of the greatest size, the first of these on a tie, is positive. Scores of rows with a missing number are null.
    """
    mean, deviations, cov, rows = covariance(df, columns, scale)
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:n]
    values, axes, total = np.maximum(0, values), axes[:, order], max(0.0, float(np.trace(cov)))
    axes = axes * np.where(axes[np.argmax(np.round(np.abs(axes), 9), axis=0), range(len(order))] < 0, -1, 1)
    found = [(c + 1, float(values[o]), float(values[o] / total) if total else None, column, float(axes[i, c]))
             for c, o in enumerate(order) for i, column in enumerate(columns)] if rows else []
    table = df.sparkSession.createDataFrame(found, "component int, variance double, share double, column string, loading double")
    by = np.where(deviations > 0, deviations, 1.0) if scale else np.ones(len(columns))
    centred = [(F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(columns, mean, by, strict=True)]
    scores = []
    for c in range(len(order)):
        score = F.lit(0.0)
        for i, v in enumerate(centred):
            score = score + v * F.lit(float(axes[i, c]))
        scores.append(score)
    return table, F.when(F.forall(F.array(*centred), lambda v: v.isNotNull()), F.array(*scores))


def k_means(df: DataFrame, key: str, columns: Sequence[str], k: int, rounds: int = 50) -> tuple[DataFrame, list[list[float]]]:
    """(key, cluster, distance) of the rows with finite numbers, and the centres; cluster counts from 0.

    Starts from the k different points of the smallest keys and ends when no centre moves, or after so many rounds. A round
    is one pass that adds up points per cluster inside the tasks: k rows reach the driver. A point as near to two centres
    goes to the first; a centre without points stays.
    """
    x = [F.col(c).cast("double") for c in columns]
    whole = F.col(key).isNotNull()
    for c in x:
        whole = whole & c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    points = stored(df.where(whole).select(F.col(key).alias("_key"), F.array(*x).alias("_x")), "points")
    firsts = points.groupBy("_x").agg(F.min("_key").alias("_key")).orderBy("_key").limit(k).collect()
    centres = [list(r["_x"]) for r in firsts]

    def nearest() -> Column:
        def far(centre: list[float]) -> Column:
            out = F.lit(0.0)
            for i, v in enumerate(centre):
                out = out + (F.col("_x")[i] - F.lit(v)) * (F.col("_x")[i] - F.lit(v))
            return out
        return F.array_min(F.array(*[F.struct(far(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]))

    for _ in range(rounds if centres else 0):
        placed = points.select("_x", nearest()["i"].alias("_i"))
        means = placed.groupBy("_i").agg(*[F.avg(F.col("_x")[i]).alias(f"m{i}") for i in range(len(x))]).collect()
        new = [list(c) for c in centres]
        for r in means:
            new[r["_i"]] = [r[f"m{i}"] for i in range(len(x))]
        if new == centres:
            break
        centres = new
    if not centres:
        return points.select(F.col("_key").alias(key), F.lit(0).alias("cluster"), F.lit(0.0).alias("distance")), []
    return points.select(F.col("_key").alias(key), nearest()["i"].alias("cluster"), F.sqrt(nearest()["d"]).alias("distance")), centres
