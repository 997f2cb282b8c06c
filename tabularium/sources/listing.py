"""Unix directory listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.functions.text import extension, scaled

# Fixed value: eight blank-separated fields, then the name (which may hold blanks).
LINE = "^\\s*(\\S+)\\s+(\\S+)\\s+(\\S+)\\s+(\\S+)\\s+(\\S+)\\s+(\\S+)\\s+(\\S+)\\s+(\\S+)\\s+(.*\\S.*)$"


def parse_listing(df: DataFrame, line: str, keep: Sequence[str] = (), mode: str | None = None) -> DataFrame:
    """Listing lines as (name, kind, size_bytes, size_mb, extension); lines with fewer fields are skipped.

    The permissions, size and name are cut out of the line in one pass each.
    """
    value = F.col(line)
    rows = df.filter(value.rlike(LINE)).select(
        *keep,
        F.regexp_extract(value, LINE, 9).alias("name"),
        F.when(F.regexp_extract(value, LINE, 1).startswith("d"), F.lit("dir")).otherwise(F.lit("file")).alias("kind"),
        F.regexp_extract(value, LINE, 5).try_cast("bigint").alias("size_bytes"))
    return rows.select(*keep, "name", "kind", "size_bytes", scaled(F.col("size_bytes"), 1e6, 3).alias("size_mb"),
                       extension(F.col("name")).alias("extension"),
                       *([F.lit(mode).alias("mode")] if mode else []))
