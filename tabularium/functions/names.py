"""Column names: normalising, renaming by map or position, safe aliases."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def normalise_name(name: str, style: str = "snake") -> str:
    """One column name in one of four styles.

    ``snake``   breaks camel case, lowers, spaces and hyphens become underscores;
    ``spaced``  lowers, each space or hyphen becomes one underscore;
    ``runs``    trims, lowers, runs of spaces and hyphens become one underscore;
    ``lower``   lowers only.
    """
    if style == "snake":
        return re.sub(r"[ \-]", "_", _CAMEL.sub("_", name).lower())
    if style == "spaced":
        return re.sub(r"[ \-]", "_", name.lower())
    if style == "runs":
        return re.sub(r"[\s\-]+", "_", name.strip().lower())
    if style == "lower":
        return name.lower()
    raise ValueError(f"unknown name style: {style}")


def normalise_names(df: DataFrame, style: str = "snake") -> DataFrame:
    """All column names in one style; two names that become equal are an error."""
    names = [normalise_name(c, style) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"names clash after normalising: {names}")
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; absent columns are left alone."""
    return df.withColumnsRenamed(dict(mapping))


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename the leading columns by position; columns beyond the list keep their name."""
    return df.toDF(*names, *df.columns[len(names):])
