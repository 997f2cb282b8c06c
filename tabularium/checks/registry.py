"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabularium.session import tasks_for

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name; ``sql`` is the equivalent over the same tables."""
    def register(fn: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"query registered twice: {name}")
        CHECKS[name] = Check(fn, sql)
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of a table whose records a task makes and reads.
RECORDS = 20_000


def spread(spark: SparkSession, folder: str, name: str, *keys: str) -> DataFrame:
    """One of the given tables, dealt over tasks by its number of rows, in turn or by keys.

    A small file holds many rows and is read by one task, too few for records that are costly to make and to read.
    """
    rows = table(spark, folder, name)
    return rows.repartition(tasks_for(spark, rows.count(), RECORDS), *keys)
