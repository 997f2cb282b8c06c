"""Names for helper columns beside a caller's columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> tuple[str, ...]:
    """The wanted names, each lengthened until no column of df has it in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def without(df: DataFrame, replaced: Iterable[str]) -> list[str]:
    """The columns of df but those that have one of the names in any case."""
    gone = {name.lower() for name in replaced}
    return [c for c in df.columns if c.lower() not in gone]
