"""Validation with named rules, guards and per-record failure capture."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, ids: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """One row (ids, rule) per record and rule it breaks; a rule states what must hold.

    A rule that is null for a record counts as broken. All rules are checked in one pass.
    """
    broken = F.filter(F.array(*[
        F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()
    ]), lambda r: r.isNotNull())
    return df.select(*ids, F.explode(broken).alias("rule"))


def require(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The same table, failing the job at the first record that breaks a rule."""
    checked = df
    for name, test in rules.items():
        checked = checked.filter(F.when(F.coalesce(test, F.lit(False)), F.lit(True))
                                  .otherwise(F.raise_error(F.lit(f"rule broken: {name}")).cast("boolean")))
    return checked


def first_error(errors: Mapping[str, Column]) -> Column:
    """Name of the first failed check of a record, null when all are fine: the error column of a batch."""
    return F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in errors.items()], F.lit(None).cast("string"))


def prefix_guard(df: DataFrame, key: str, prefixes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Whether all keys (of each part) start with an allowed prefix; a part that fails is stale."""
    allowed = F.lit(False)
    for p in prefixes:
        allowed = allowed | F.col(key).startswith(p)
    return df.groupBy(*by).agg(F.count("*").alias("n_keys"), F.count_if(~allowed).alias("n_foreign"),
                               F.bool_and(allowed).alias("valid"))
