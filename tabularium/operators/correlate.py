"""Pairwise Pearson correlation of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corr_matrix(df: DataFrame, columns: Sequence[str], digits: int = 6, lower_only: bool = False) -> DataFrame:
    """Correlations as (a, b, r) rows from one aggregate pass over the table.

    A pair uses the rows where both columns have values. Each pair is computed once and
    mirrored; ``lower_only`` keeps the lower triangle with the diagonal, in column order.
    """
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    wide = df.agg(*[F.corr(F.col(columns[i]).cast("double"), F.col(columns[j]).cast("double")).alias(f"r_{i}_{j}")
                    for i, j in pairs])
    cells = [(columns[i], columns[j], f"r_{i}_{j}") for i, j in pairs]
    if not lower_only:
        cells += [(columns[j], columns[i], f"r_{i}_{j}") for i, j in pairs if i != j]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(r), digits).alias("r")) for a, b, r in cells])))
