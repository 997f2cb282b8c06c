"""Lookup, semi, anti and fallback joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Attributes of a dimension added by key; rows without a match stay with nulls.

    No hint: Spark broadcasts by the measured size of the dimension and AQE splits hot keys
    of a shuffle join.
    """
    return df.join(dim, [on] if isinstance(on, str) else list(on), how)


def label_by(key: Column, labels: Mapping, default: Column | None = None) -> Column:
    """Label from a small dictionary in the code, as a map literal; no join."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, default)


def both_in(df: DataFrame, keys: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """Rows whose two columns are both in a key set."""
    ids = keys.select(key).distinct()
    return (df.join(ids.withColumnRenamed(key, left), left, "left_semi")
              .join(ids.withColumnRenamed(key, right), right, "left_semi").select(*df.columns))


def not_yet(df: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in a manifest."""
    return df.join(done.select(*on).distinct(), list(on), "left_anti")


def primary_else(primary: DataFrame, fallback: DataFrame, key: str, labels: tuple[str, str], out: str = "source") -> DataFrame:
    """Rows of the primary source, and of the fallback for keys the primary lacks, labelled by source."""
    rest = fallback.join(primary.select(key).distinct(), key, "left_anti")
    return primary.withColumn(out, F.lit(labels[0])).unionByName(rest.withColumn(out, F.lit(labels[1])))
