"""Tables inside zip archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

LINES_SCHEMA = "path string, member string, line_no bigint, line string"
#: Characters after which a batch of lines is handed on, however few lines it has.
CHARACTERS = 4 << 20


def read_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Zip files as (path, content) rows, spread over the tasks by archive."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def archive_lines(archives: DataFrame, suffix: str, batch: int = 20_000) -> DataFrame:
    """Lines of every member with the suffix in each archive, named by ``member``; archives without one give none.

    Spark has no zip codec, so this is the one Python step. A task holds one archive at a
    time and hands its lines on in batches while it inflates, those of many small archives
    in one; the lines are parsed by the delimited reader on the JVM side.
    """
    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in dict.fromkeys(n for n in archive.namelist() if n.endswith(suffix)):
                        with archive.open(member) as raw:
                            for number, line in enumerate(io.TextIOWrapper(raw, encoding="utf-8", newline="\n")):
                                rows.append((path, member, number, line.rstrip("\r\n")))
                                size += len(line)
                                if len(rows) >= batch or size >= CHARACTERS:
                                    yield _frame(rows)
                                    rows, size = [], 0
        if rows:
            yield _frame(rows)

    return archives.select("path", "content").mapInPandas(lines, LINES_SCHEMA)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["path", "member", "line_no", "line"])
