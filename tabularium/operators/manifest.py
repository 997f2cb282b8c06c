"""Landing bookkeeping: what still has to be fetched, and what a batch did."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.operators.lookup import not_yet


def to_land(listing: DataFrame, manifest: DataFrame, on: Sequence[str] = ("name", "size_bytes")) -> DataFrame:
    """Listed files that are not landed with the same size (a truncated file is fetched again)."""
    return not_yet(listing, manifest, on)


def land_report(listing: DataFrame, manifest: DataFrame, on: Sequence[str] = ("name", "size_bytes"),
                size: str = "size_bytes") -> DataFrame:
    """Files and bytes planned, skipped (already landed) and still to do, as one row."""
    done = manifest.select(*on).distinct().withColumn("_done", F.lit(True))
    marked = listing.join(done, list(on), "left").select(size, F.coalesce("_done", F.lit(False)).alias("_done"))
    bytes_of = lambda test: F.coalesce(F.sum(F.when(test, F.col(size))), F.lit(0))
    return marked.agg(
        F.count("*").alias("n_planned"), F.count_if("_done").alias("n_skipped"), F.count_if(~F.col("_done")).alias("n_todo"),
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes_planned"), bytes_of(F.col("_done")).alias("bytes_skipped"),
        bytes_of(~F.col("_done")).alias("bytes_todo"))
