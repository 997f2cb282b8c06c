"""Writing tables and checking what was written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, codec: str = "snappy", partition_by: Sequence[str] = (),
                  sort_within: Sequence[str] = ()) -> DataFrame:
    """Write Parquet and give back the stored table. ``codec`` is any Parquet codec, for example zstd.

    ``sort_within`` orders rows inside each file, which tightens the row-group statistics.
    """
    ready = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = ready.write.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_json(df: DataFrame, path: str) -> DataFrame:
    """Write JSON lines and give back the stored table."""
    df.write.option("ignoreNullFields", False).json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row that compares two tables as bags: sizes, differing rows, equal schema, verdict.

    One shuffle: both are stacked with weights +1 and -1 and summed per distinct row.
    """
    same_schema = [(f.name, f.dataType) for f in a.schema.fields] == [(f.name, f.dataType) for f in b.schema.fields]
    if not same_schema:
        return a.agg(F.count("*").alias("n_left")).select(
            "n_left", F.lit(None).cast("bigint").alias("n_right"), F.lit(None).cast("bigint").alias("n_differ"),
            F.lit(False).alias("same_schema"), F.lit(False).alias("ok"))
    stacked = a.withColumn("_w", F.lit(1)).unionByName(b.withColumn("_w", F.lit(-1)))
    per_row = stacked.groupBy(*a.columns).agg(F.sum("_w").alias("_d"), F.count_if(F.col("_w") == 1).alias("_l"),
                                              F.count_if(F.col("_w") == -1).alias("_r"))
    return per_row.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("n_left"), F.coalesce(F.sum("_r"), F.lit(0)).alias("n_right"),
        F.coalesce(F.sum(F.abs("_d")), F.lit(0)).alias("n_differ"),
    ).select("*", F.lit(True).alias("same_schema"), (F.col("n_differ") == 0).alias("ok"))
