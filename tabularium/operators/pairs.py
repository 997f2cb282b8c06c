"""Pairs of rows that share a key, with frequent keys dealt over several tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import stored

#: Rows of a key that meet all rows of that key in one task.
STRIPE = 2000


def pairs_by_key(df: DataFrame, key: str, name: str, carry: Sequence[str] = (), tasks: int | None = None) -> DataFrame:
    """(key, a, b, a_<carry>..., b_<carry>...): rows of the same key, the smaller name first; names are unique per key.

    A key with many rows is cut into stripes by a hash of the name: a stripe's rows are on the left in one task only, and
    the right side is copied to every stripe. A task then holds STRIPE left rows of a key or so, whatever its number of
    rows; a key of few rows is one stripe and nothing is copied. Null keys and names make no pair. With tasks, keys and
    stripes are dealt over so many tasks.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(name).isNotNull()).select(F.col(key).alias("_key"), F.col(name).alias("_name"), *carry)
    stripes = rows.groupBy("_key").agg(F.ceil(F.count("*") / STRIPE).cast("int").alias("_stripes")).where("_stripes > 1")
    # Written, so that the few frequent keys are copied to the rows and the rows are not shuffled to them.
    stripes = stored(stripes, "stripes")
    dealt = rows.join(stripes.withColumnRenamed("_key", "_of"), F.col("_key") == F.col("_of"), "left").withColumn("_stripes", F.coalesce("_stripes", F.lit(1)))
    left = dealt.select("_key", F.pmod(F.xxhash64("_name"), F.col("_stripes")).cast("int").alias("_stripe"), F.col("_name").alias("a"),
                        *[F.col(c).alias(f"a_{c}") for c in carry])
    right = dealt.select("_key", F.explode(F.sequence(F.lit(0), F.col("_stripes") - 1)).alias("_stripe"), F.col("_name").alias("b"),
                         *[F.col(c).alias(f"b_{c}") for c in carry])
    if tasks:
        left, right = (side.repartition(tasks, "_key", "_stripe") for side in (left, right))
    return left.join(right, ["_key", "_stripe"]).where("a < b").drop("_stripe").withColumnRenamed("_key", key)
