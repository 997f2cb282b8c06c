"""Size of the Arrow batches between Spark and Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of whole texts in a batch: a task holds a batch and what is made of it.
ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Texts may be long, so batches of the session get ROWS rows at most; a smaller setting stays."""
    if not 0 < int(spark.conf.get(SETTING)) <= ROWS:
        spark.conf.set(SETTING, ROWS)
