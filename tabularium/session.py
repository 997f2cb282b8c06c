"""Session defaults, the shared work folder and lineage cutting."""

from __future__ import annotations

import atexit
import math
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tabularium", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library assumes; the cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only a session whose executors run inside the driver (a local test) may leave it unset; it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if not named and current is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tabularium-")
    if current is None:
        spark.sparkContext.setCheckpointDir(named)
    return (named or current).rstrip("/")


_made: list[tuple[SparkSession, str]] = []
#: What the innermost stored_alone of a thread has had written.
_scope = threading.local()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses; the driver removes it when it exits or on clear_work."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    if getattr(_scope, "made", None) is not None:
        _scope.made.append((spark, path))
    return path


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def clear_work() -> None:
    """Remove every folder that fresh_path has named. Frames that still read them must not be used afterwards."""
    while _made:
        _remove(*_made.pop())


atexit.register(clear_work)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written as Parquet below the shared folder and read again: evaluated once, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """The frame that make returns, stored; the folders it had written on the way are removed.

    make must leave no other frame that reads them. If it fails, they stay until clear_work.
    """
    outer, _scope.made = getattr(_scope, "made", None), []
    try:
        frame, made = make(), _scope.made
    finally:
        _scope.made = outer
    frame = stored(frame, label)
    for each in made:
        _remove(*each)
        _made.remove(each)
    return frame


#: Rows of moderate width that one task sorts or groups.
TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int, per: int = TASK_ROWS) -> int:
    """Tasks for so many rows, so that a task's share stays the same size whatever number of shuffle partitions is set."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / per))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
