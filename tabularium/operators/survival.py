"""Survival curves from times to an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.special import chi_squared_tail
from tabularium.operators.indexing import running_total


def _event_times(df: DataFrame, time: str, event: Column, by: Sequence[str]) -> DataFrame:
    """(by..., _minus, _n, _d): rows and events per time, with the time negated so that the latest comes first."""
    t = F.nanvl(F.col(time).cast("double"), F.lit(None).cast("double"))
    rows = df.select(*by, t.alias("_t"), F.coalesce(event, F.lit(False)).alias("_e")).where("_t IS NOT NULL")
    return rows.groupBy(*by, (-F.col("_t")).alias("_minus")).agg(F.count("*").alias("_n"), F.count_if("_e").alias("_d"))


def kaplan_meier(df: DataFrame, time: str, event: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by..., time, at_risk, events, survival, std_error), one row per time with an event; null is a group.

    Rows are folded per time. How many are at risk is a running total from the latest time down, and survival a running sum
    of logarithms from the first time up, both over a range-partitioned sort, so a group goes over many tasks. Survival is 0
    exactly from a time on at which all at risk have the event. The standard error is Greenwood's. Rows without a time or
    with NaN are left out; a null event is none, and counts as at risk up to its time.
    """
    by = list(by)
    at_risk = running_total(_event_times(df, time, event, by), by, ["_minus"], "_n", "at_risk").where("_d > 0")
    n, d = F.col("at_risk"), F.col("_d")
    steps = at_risk.select(*by, (-F.col("_minus")).alias("time"), "at_risk", d.alias("events"),
                           F.when(d < n, F.log1p(-d / n)).otherwise(0.0).alias("_log"), F.when(d < n, d / (n * (n - d).cast("double"))).otherwise(0.0).alias("_var"),
                           (d == n).cast("int").alias("_end"))
    # One running total of a struct of sums would need its own aggregate; the three columns are totalled one after another.
    for c in ("_log", "_var", "_end"):
        steps = running_total(steps, by, ["time"], c, f"{c}_sum")
    survival = F.when(F.col("_end_sum") > 0, 0.0).otherwise(F.exp("_log_sum"))
    return steps.select(*by, "time", "at_risk", "events", survival.alias("survival"), (survival * F.sqrt("_var_sum")).alias("std_error"))


def log_rank(df: DataFrame, time: str, event: Column, group: str, first: object, second: object) -> DataFrame:
    """One row (observed, expected, variance, chi2, p): the log-rank test of two groups, observed and expected of the first."""
    both = df.where(F.col(group).isin(first, second)).select(time, event.alias("_event"), (F.col(group) == F.lit(first)).cast("int").alias("_first"))
    t = F.nanvl(F.col(time).cast("double"), F.lit(None).cast("double"))
    rows = both.select(t.alias("_t"), F.coalesce("_event", F.lit(False)).alias("_e"), "_first").where("_t IS NOT NULL")
    folded = rows.groupBy((-F.col("_t")).alias("_minus")).agg(F.count("*").alias("_n"), F.count_if("_e").alias("_d"), F.sum("_first").alias("_n1"),
                                                              F.count_if(F.col("_e") & (F.col("_first") == 1)).alias("_d1"))
    risk = running_total(running_total(folded, [], ["_minus"], "_n", "_r"), [], ["_minus"], "_n1", "_r1").where("_d > 0")
    r, r1, d = (F.col(c).cast("double") for c in ("_r", "_r1", "_d"))
    spread = F.when(r > 1, d * (r1 / r) * (1 - r1 / r) * (r - d) / (r - 1)).otherwise(0.0)
    sums = risk.agg(F.coalesce(F.sum("_d1"), F.lit(0)).alias("observed"), F.coalesce(F.sum(d * r1 / r), F.lit(0.0)).alias("expected"), F.coalesce(F.sum(spread), F.lit(0.0)).alias("variance"))
    chi2 = F.try_divide((F.col("observed") - F.col("expected")) * (F.col("observed") - F.col("expected")), F.col("variance"))
    return sums.withColumn("chi2", chi2).withColumn("p", F.when(F.col("chi2").isNotNull(), chi_squared_tail(F.col("chi2"), F.lit(1))))
