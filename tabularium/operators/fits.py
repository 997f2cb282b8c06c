"""Fits of distributions and trends, and bootstrap intervals, from partial sums."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.operators.indexing import row_index, running_total
from tabularium.session import stored

#: Cut-offs tried for a power law at most.
CUTS = 50
#: Shares of a Poisson distribution of mean 1 up to 0, 1, 2, ...: a uniform number below the k-th one draws at most k.
POISSON_SHARES = tuple(math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1)) for k in range(12))


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """(x, n): how often each positive finite value occurs."""
    x = F.col(value).cast("double")
    return df.select(x.alias("x")).where((F.col("x") > 0) & (F.col("x") < float("inf"))).groupBy("x").agg(F.count("*").alias("n"))


def power_law(df: DataFrame, value: str, cuts: int = CUTS) -> DataFrame:
    """(cut, n_tail, alpha, ks, best) for whole positive numbers, one row per cut-off tried.

    Cut-offs are all different values if there are at most so many, else the values next above a logarithmic grid. alpha is
    the maximum-likelihood exponent with the half-step correction, ks the greatest gap between the tail's shares and the
    law's, best marks the smallest gap, the lower cut-off on a tie. Tails of one value have no exponent and are left out.
    Everything comes from one table of counts: its running total, made once, gives the shares for all cut-offs.
    """
    counts = stored(value_counts(df, value), "value-counts")
    low, high, different = counts.agg(F.min("x"), F.max("x"), F.count("*")).first()
    if not different:
        return df.sparkSession.createDataFrame([], "cut double, n_tail long, alpha double, ks double, best boolean")
    if different <= cuts:
        tried = sorted(r["x"] for r in counts.select("x").collect())
    else:
        grid = [low * (high / low) ** (i / cuts) for i in range(cuts)]
        tried = sorted({x for x in counts.agg(*[F.min(F.when(F.col("x") >= g, F.col("x"))) for g in grid]).first() if x is not None})
    inside = [F.col("x") >= c for c in tried]
    sums = counts.agg(*[s for i in inside for s in (F.sum(F.when(i, F.col("n"))), F.sum(F.when(i, F.col("n") * F.log("x"))), F.min(F.when(i, F.col("x"))) == F.max(F.when(i, F.col("x"))))]).first()
    everything = sums[0]
    laws = []
    for k, cut in enumerate(tried):
        n, logs, single = sums[3 * k:3 * k + 3]
        if not single:
            laws.append((cut, n, everything - n, 1 + n / (logs - n * math.log(cut - 0.5))))
    if not laws:
        return df.sparkSession.createDataFrame([], "cut double, n_tail long, alpha double, ks double, best boolean")
    running = running_total(counts, [], ["x"], "n", "upto")
    each = F.array(*[F.struct(F.lit(c).alias("cut"), F.lit(n).cast("bigint").alias("n_tail"), F.lit(b).cast("bigint").alias("below"), F.lit(a).alias("alpha")) for c, n, b, a in laws])
    spread = running.select("x", "upto", F.explode(each).alias("e")).select("x", "upto", "e.*").where("x >= cut")
    law = 1 - F.pow((F.col("x") + 0.5) / (F.col("cut") - 0.5), 1 - F.col("alpha"))
    gaps = spread.groupBy("cut").agg(F.max("n_tail").alias("n_tail"), F.max("alpha").alias("alpha"), F.max(F.abs((F.col("upto") - F.col("below")) / F.col("n_tail") - law)).alias("ks"))
    gaps = stored(gaps, "power-law")
    best = gaps.orderBy("ks", "cut").select("cut").first()["cut"]
    return gaps.withColumn("best", F.col("cut") == F.lit(best))


def compare_tails(df: DataFrame, value: str) -> DataFrame:
    """(model, first, second, log_likelihood, aic) of positive values: power law from the minimum on, log-normal, exponential.

    first and second are the exponent and the cut-off, the mean and deviation of the logarithms, or the rate. One pass.
    """
    x = F.col("x")
    n, logs, squares, total, low = value_counts(df, value).agg(
        F.sum("n"), F.sum(F.col("n") * F.log(x)), F.sum(F.col("n") * F.log(x) * F.log(x)), F.sum(F.col("n") * x), F.min(x)).first()
    rows = []
    if n:
        above = logs - n * math.log(low)
        if above > 0:
            alpha = 1 + n / above
            rows.append(("power law", alpha, low, n * math.log((alpha - 1) / low) - alpha * above, 2))
        mean, variance = logs / n, max(0.0, squares / n - (logs / n) ** 2)
        if variance > 0:
            rows.append(("log-normal", mean, math.sqrt(variance), -logs - n / 2 * math.log(2 * math.pi * variance) - n / 2, 2))
        rows.append(("exponential", n / total, None, n * math.log(n / total) - n, 1))
    found = [(m, a, b, float(ll), 2.0 * k - 2.0 * ll) for m, a, b, ll, k in rows]
    return df.sparkSession.createDataFrame(found, "model string, first double, second double, log_likelihood double, aic double")


def zipf(df: DataFrame, key: str) -> DataFrame:
    """One row (n_values, total, slope, intercept, r2): the logarithm of the frequency against that of the rank.

    The most frequent value has rank 1, ties by value; null is no value. Ranks come from a range-partitioned sort.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("v")).agg((-F.count("*")).alias("minus"))
    ranked = row_index(counts, "minus", "v", out="_rank")
    x, y = F.log(F.col("_rank") + 1), F.log(-F.col("minus").cast("double"))
    return ranked.agg(F.count("*").alias("n_values"), F.coalesce(F.sum(-F.col("minus")), F.lit(0)).alias("total"), F.regr_slope(y, x).alias("slope"),
                      F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def poisson_draws(df: DataFrame, key: Column, replicates: int) -> DataFrame:
    """The rows with columns replicate (from 1) and weight, how often the replicate draws the row: Poisson of mean 1, from the
    MD5 of the key alone; rows that a replicate does not draw are left out. Replicate 0 holds every row once.

    Two halves of the hash give a sequence whose members are uniform and pairwise independent over rows. The hash is taken
    once per row, before the replicates, and a weight is a comparison of whole numbers.
    """
    hashed = df.withColumn("_md5", F.md5(key.cast("string")))
    start, step = (F.conv(F.substring("_md5", at, 8), 16, 10).cast("bigint") for at in (1, 9))
    each = hashed.select(*df.columns, start.alias("_start"), step.alias("_step")).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(replicates))).alias("replicate"))
    u = F.pmod(F.col("_start") + F.col("replicate") * F.col("_step"), F.lit(1 << 32))
    weight = F.when(F.col("replicate") == 0, F.lit(1))
    limits = [math.ceil(share * (1 << 32)) for share in POISSON_SHARES]
    for drawn, limit in enumerate(limits):
        weight = weight.when(u < F.lit(limit), F.lit(drawn))
    # A null key has no u, and so no weight.
    return each.select(*df.columns, "replicate", weight.when(u >= F.lit(limits[-1]), F.lit(len(limits))).alias("weight")).where("weight > 0")


def bootstrap_mean(df: DataFrame, value: str, key: str, by: Sequence[str] = (), replicates: int = 200, level: float = 0.95) -> DataFrame:
    """(by..., n, mean, low, high): the mean and its percentile interval over bootstrap replicates, in one pass.

    Instead of drawing rows, every row gets a Poisson weight per replicate from a hash of its key, so the result is the same
    however rows are dealt, and repeated after a failure. Weighted sums are partial: a task sends one row per group and
    replicate. Missing and NaN values are left out; rows of one key are drawn together.
    """
    by = list(by)
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    rows = df.select(*by, v.alias("_v"), F.col(key).alias("_key")).where("_v IS NOT NULL")
    drawn = poisson_draws(rows, F.col("_key"), replicates)
    means = drawn.groupBy(*by, "replicate").agg(F.sum("weight").alias("_n"), (F.sum(F.col("_v") * F.col("weight")) / F.sum("weight")).alias("_mean"))
    real, tail = F.col("replicate") == 0, (1 - level) / 2
    spread = F.percentile(F.when(~real, F.col("_mean")), F.array(F.lit(tail), F.lit(1 - tail)))
    return means.groupBy(*by).agg(F.max(F.when(real, F.col("_n"))).alias("n"), F.max(F.when(real, F.col("_mean"))).alias("mean"), spread.alias("_s")).select(
        *by, "n", "mean", F.get("_s", F.lit(0)).alias("low"), F.get("_s", F.lit(1)).alias("high"))


def exponential_growth(df: DataFrame, time: str, value: str, ahead: Sequence[float] = ()) -> DataFrame:
    """(kind, time, value): 'rate', 'doubling' and 'r2' of the least-squares line through log(value), and a 'forecast' for each
    further time. Values that are not positive are left out; without two different times there is no row."""
    t, y = F.col(time).cast("double"), F.log(F.when(F.col(value) > 0, F.col(value).cast("double")))
    slope, start, r2 = df.agg(F.regr_slope(y, t), F.regr_intercept(y, t), F.regr_r2(y, t)).first()
    rows = []
    if slope is not None:
        rows = [("rate", None, slope), ("doubling", None, math.log(2) / slope if slope else None), ("r2", None, r2)]
        rows += [("forecast", float(a), math.exp(start + slope * a)) for a in ahead]
    return df.sparkSession.createDataFrame(rows, "kind string, time double, value double")
