"""Which sets hold more of a selection than chance would give, and how sets overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.functions.special import hypergeometric_tail
from tabularium.operators.multiple import adjust
from tabularium.operators.pairs import pairs_by_key
from tabularium.session import stored, tasks_for

#: Pairs of sets with a common member that one task makes.
TASK_PAIRS = 2_000_000


def over_representation(sets: DataFrame, name: str, member: str, chosen: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """(set, size, hits, expected, fold, p, p_bonferroni, p_bh) for every set: the upper tail of the hypergeometric distribution.

    sets holds (name, member) rows, chosen and universe a column member each; without a universe it is all members of sets.
    Repeated and null members and those outside the universe count for nothing. The tail is summed from the logarithm of its
    first term, so p-values far below the smallest double come out as 0 and all others are right. Sets are counted by
    partial sums; two counts reach the driver.
    """
    inside = (sets if universe is None else universe).where(F.col(member).isNotNull()).select(F.col(member).alias("_m")).distinct()
    picked = chosen.where(F.col(member).isNotNull()).select(F.col(member).alias("_m")).distinct().withColumn("_hit", F.lit(True))
    flagged = inside.join(picked, "_m", "left")
    total, drawn = flagged.agg(F.count("*"), F.count("_hit")).first()
    rows = sets.where(F.col(name).isNotNull()).select(F.col(name).alias("set"), F.col(member).alias("_m")).distinct()
    counted = rows.join(flagged, "_m").groupBy("set").agg(F.count("*").alias("size"), F.count("_hit").alias("hits"))
    expected = F.col("size") * F.lit(drawn / total if total else 0.0)
    tested = counted.select("set", "size", "hits", expected.alias("expected"), F.try_divide(F.col("hits").cast("double"), expected).alias("fold"),
                            hypergeometric_tail(F.col("hits"), F.lit(drawn), F.col("size"), F.lit(total)).alias("p"))
    return adjust(tested, "p").select("set", "size", "hits", "expected", "fold", "p", "p_bonferroni", "p_bh")


def set_overlaps(sets: DataFrame, name: str, member: str, least: int = 1) -> DataFrame:
    """(a, b, shared, jaccard) for sets with at least so many members in common, a before b.

    Pairs come from the members (an inverted index), never from comparing all sets with all; a member of very many sets is
    dealt over tasks. Pairs are counted before they are made, one sum to the driver, and there are as many tasks as the
    pairs need, so that what a task counts does not grow with the input.
    """
    spark, known = sets.sparkSession, F.col(name).isNotNull() & F.col(member).isNotNull()
    tasks = tasks_for(spark, sets.count())
    rows = sets.where(known).select(F.col(name).alias("set"), F.col(member).alias("member")).repartition(tasks, "set", "member").distinct()
    rows = stored(rows, "set-members")
    sizes = stored(rows.repartition(tasks, "set").groupBy("set").agg(F.count("*").alias("_size")), "set-sizes")
    met = rows.repartition(tasks, "member").groupBy("member").agg(F.count("*").alias("n"))
    pairs = met.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0
    made = tasks_for(spark, pairs, TASK_PAIRS)
    taken = tasks_for(spark, pairs, 2 * TASK_PAIRS)
    made_pairs = pairs_by_key(rows, "member", "set", tasks=made).select("a", "b").repartition(taken, "a", "b")
    shared = made_pairs.groupBy("a", "b").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)
    # The sizes are written first, so that few of them are copied to the pairs.
    for c in "ab":
        shared = shared.join(sizes.select(F.col("set").alias(c), F.col("_size").alias(f"_{c}")), c)
    return shared.select("a", "b", "shared", (F.col("shared") / (F.col("_a") + F.col("_b") - F.col("shared"))).alias("jaccard"))
