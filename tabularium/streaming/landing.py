"""Incremental landing: a file stream whose checkpoint is the manifest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def page_stream(spark: SparkSession, path: str, files_per_batch: int | None = None, whole: bool = False) -> DataFrame:
    """Landed page files as a stream of (value) rows: one row per line, or per file when ``whole``."""
    reader = spark.readStream.format("text").option("wholetext", whole)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def record_stream(spark: SparkSession, path: str, schema: str | T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Landed JSON-lines files as a stream of typed records."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def land_new(stream: DataFrame, flatten: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Flatten what arrived since the last run and append it to a Parquet table, then stop.

    The checkpoint remembers the files that were read, so a file lands once however often
    the job runs; the file sink commits each batch once. ``flatten`` is the function the
    batch job uses too.
    """
    query = (flatten(stream).writeStream.format("parquet").outputMode("append")
             .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
