"""Evidence of several channels as one probability, and ranks as scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _corrected(none: Column, prior: float) -> Column:
    """1 minus the chance that no channel holds, without what the prior alone explains; not below 0."""
    value = ((1 - none) - F.lit(float(prior))) / F.lit(1 - float(prior))
    return F.when(value < 0, 0.0).otherwise(value)


def combine_channels(channels: Sequence[Column], prior: float = 0.0) -> Column:
    """1 - product(1 - p) over the channels of a row, corrected for a prior below 1. A missing channel is no evidence."""
    none = F.lit(1.0)
    for p in channels:
        none = none * (1 - F.coalesce(p.cast("double"), F.lit(0.0)))
    return _corrected(none, prior)


def combine_rows(df: DataFrame, by: Sequence[str], p: str, prior: float = 0.0) -> DataFrame:
    """(by..., n, combined): the same over the rows of a group, by adding up logarithms, which merges over tasks.

    A probability of 1 makes the result 1 exactly, one of 0 changes nothing, and many tiny ones keep their digits. Null and
    NaN are no evidence; a group without any has combined 0, less the prior. Values outside 0 to 1 fail the job.
    """
    v = F.nanvl(F.col(p).cast("double"), F.lit(None).cast("double"))
    checked = F.when((v < 0) | (v > 1), F.raise_error(F.lit("probability outside 0 to 1")).cast("double")).otherwise(v)
    sums = df.select(*by, checked.alias("_p")).groupBy(*by).agg(
        F.count("_p").alias("n"), F.max((F.col("_p") == 1).cast("int")).alias("_sure"), F.sum(F.when(F.col("_p") < 1, F.log1p(-F.col("_p")))).alias("_log"))
    combined = F.when(F.col("_sure") == 1, 1.0).otherwise(-F.expm1(F.coalesce("_log", F.lit(0.0))))
    value = (combined - F.lit(float(prior))) / F.lit(1 - float(prior))
    return sums.select(*by, "n", F.when(value < 0, 0.0).otherwise(value).alias("combined"))


def rank_score(df: DataFrame, rank: str, by: Sequence[str], out: str = "score") -> DataFrame:
    """(max - rank) / (max - min) * 100 within the group: 100 for the best rank, 0 for the worst; null where all are equal.

    Extremes are partial aggregates, joined back by group, null a group like others; a column named out is replaced.
    """
    limits = df.groupBy(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(by)]).agg(F.min(rank).alias("_low"), F.max(rank).alias("_high"))
    match = F.lit(True)
    for i, k in enumerate(by):
        match = match & F.col(k).eqNullSafe(F.col(f"_b{i}"))
    value = F.try_divide((F.col("_high") - F.col(rank)) * F.lit(100.0), F.col("_high") - F.col("_low"))
    return df.join(limits, match, "left").withColumn(out, value).select(*[c for c in df.columns if c != out], out)
