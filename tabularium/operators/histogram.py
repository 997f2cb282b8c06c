"""Fixed-width histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per bin of equal width between the smallest and largest value: (bin, lower, upper, n_rows).

    The last bin is closed on the right. Empty bins are kept. The range is one row and is
    read first; the counting pass then has a partial sum per bin. NaN lies in no bin: if there is
    any, a row with a null bin counts it. Nulls count nowhere.
    """
    value = F.col(column).cast("double")
    number = F.when(~F.isnan(value), value)
    low, high, odd = df.agg(F.min(number), F.max(number), F.count_if(F.isnan(value))).first()
    spark = df.sparkSession
    nans = spark.range(1 if odd else 0).select(F.lit(None).cast("int").alias("bin"), F.lit(float("nan")).alias("lower"),
                                               F.lit(float("nan")).alias("upper"), F.lit(odd).cast("bigint").alias("n_rows"))
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if low is None:
        return edges.select("bin", F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"),
                            F.lit(0).cast("bigint").alias("n_rows")).union(nans)
    width = (high - low) / bins
    place = F.lit(0) if width == 0 else F.least(F.floor((number - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    counted = df.filter(number.isNotNull()).groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n_rows"))
    # At most ``bins`` rows on either side.
    return edges.join(F.broadcast(counted), "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce(F.col("n_rows"), F.lit(0)).alias("n_rows")).union(nans)
