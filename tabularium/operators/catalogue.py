"""What is stored: rows and bytes per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stored_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Rows and bytes per stored file: (file, n_rows, n_bytes). Reads no data columns."""
    return (spark.read.format(fmt).load(path)
                 .groupBy(F.col("_metadata.file_name").alias("file"))
                 .agg(F.count("*").alias("n_rows"), F.max("_metadata.file_size").alias("n_bytes")))


def stored_size(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Files, rows, bytes and bytes per row of a stored table, in place of an in-memory size."""
    return stored_files(spark, path, fmt).agg(
        F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"),
        F.round(F.sum("n_bytes") / F.sum("n_rows"), 2).alias("bytes_per_row"))


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows as a table; the scan below has no data columns."""
    return df.agg(F.count("*").alias("n_rows"))
