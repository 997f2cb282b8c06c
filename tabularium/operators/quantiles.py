"""Exact quantiles without holding a group's values in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.operators.indexing import running_total
from tabularium.session import stored

# The approximate ranks below are good to 1/ACCURACY of the group; the bracket is wider.
ACCURACY = 20_000
MARGIN = 4.0 / ACCURACY
# Join keys that a group's rows are dealt over when its limits are joined back.
SALTS = 64


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles as rows (by..., column, prob, value).

    ``percentile`` keeps every distinct value of a group in one task. Here a first pass finds
    a narrow bracket around each wanted rank from an approximate summary. A second pass counts
    rows per value inside the brackets and in one lump per stretch between them; the counts
    are partial sums spread by value. Only the values inside brackets, a fixed small share of
    a group, are put in order. A rank that fell outside its bracket fails the job, so the
    result is exact or absent, never near.
    """
    by, probs = list(by), sorted({float(p) for p in probs})
    keys = [*by, "column"]
    data = df.select(*by, *[F.col(c).cast("double").alias(f"_v{j}") for j, c in enumerate(columns)])
    # Written, as it is read twice and its size then is known: few groups are copied to the rows, which are not shuffled.
    summary = stored(_summaries(data, by, len(columns), probs), "summaries")
    if by:
        cond = F.lit(True)
        for k in by:
            cond = cond & F.col(f"l.{k}").eqNullSafe(F.col(f"b.{k}"))
        joined = data.alias("l").join(summary.alias("b"), cond).select(
            *[F.col(f"l.{k}").alias(k) for k in by], *[F.col(f"_v{j}") for j in range(len(columns))],
            *[F.col(f"_s{j}") for j in range(len(columns))])
        ranges = [_ranges(lambda f, j=j: F.col(f"_s{j}.{f}"), probs) for j in range(len(columns))]
    else:
        # One row in all: its numbers become literals.
        only, joined = summary.first(), data
        ranges = [_ranges(lambda f, s=only[f"_s{j}"]: F.lit(s[f]) if f != "q" else F.array(
            *[F.lit(x) for x in s["q"] or [None] * 2 * len(probs)]), probs) for j in range(len(columns))]

    def place_of(j: int) -> Column:
        """The value itself inside a bracket, else the lower end of the next bracket, else null."""
        v, n = F.col(f"_v{j}"), ranges[j][0]
        inside, lump = F.lit(False), []
        for lo, hi in ranges[j][1]:
            inside = inside | v.between(lo, hi)
            lump.append(F.when(v < lo, lo))
        return F.struct(n.cast("bigint").alias("n"), F.coalesce(inside, F.lit(False)).alias("in"),
                        F.when(inside, v).otherwise(F.coalesce(*lump)).cast("double").alias("at"))

    wide = joined.select(*by, *[place_of(j).alias(f"_c{j}") for j in range(len(columns))]).toDF(*by, *columns)
    counts = (wide.unpivot(by, list(columns), "column", "_p")
              .select(*keys, F.col("_p.n").alias("_n"), F.col("_p.at").alias("_at"), F.col("_p.in").alias("_in"))
              .filter(F.col("_at").isNotNull()).groupBy(*keys, "_n", "_at", "_in").agg(F.count("*").alias("_c")))

    # A lump sorts just before the bracket it lies below (false sorts before true).
    ranked = running_total(counts, keys, ["_at", "_in"], "_c", "_upto")

    def at(rank: Column) -> Column:
        hit = F.col("_in") & (F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank)
        return F.max(F.when(hit, F.col("_at")))

    place = [F.lit(p) * (F.col("_n") - 1) for p in probs]
    picked = ranked.groupBy(*keys).agg(F.first("_n").alias("_n"), *[
        F.struct(at(F.floor(pos)).alias("lo"), at(F.ceil(pos)).alias("hi")).alias(f"_q{i}") for i, pos in enumerate(place)])
    values = picked.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(p).alias("prob"), _between(F.col(f"_q{i}"), place[i]).alias("value")) for i, p in enumerate(probs)])))
    # A group without a value has no rank to find; its quantiles are null.
    bare = F.filter(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_s{j}.n").alias("n")) for j, c in enumerate(columns)]), lambda s: s["n"] == 0)
    empty = summary.select(*by, F.explode(bare).alias("_e")).select(*by, "_e.column", F.explode(F.array(*[F.lit(p) for p in probs])).alias("prob"))
    return values.unionByName(empty.withColumn("value", F.lit(None).cast("double")))


def _summaries(data: DataFrame, by: list[str], n_columns: int, probs: list[float]) -> DataFrame:
    """Row count, extremes and approximate bracket ends of every column, one row per group."""
    ends = [max(p - MARGIN, 0.0) for p in probs] + [min(p + MARGIN, 1.0) for p in probs]
    return data.groupBy(*by).agg(*[F.struct(
        F.count(f"_v{j}").alias("n"), F.min(f"_v{j}").alias("min"), F.max(f"_v{j}").alias("max"),
        F.percentile_approx(f"_v{j}", ends, ACCURACY).alias("q")).alias(f"_s{j}") for j in range(n_columns)])


def _ranges(field: Callable[[str], Column], probs: list[float]) -> tuple[Column, list[tuple[Column, Column]]]:
    """Row count of a summary and, per probability, the value range that holds the wanted rank.

    A group of at most ACCURACY rows is its own bracket: there the margin is less than one
    rank wide.
    """
    whole = field("n") <= ACCURACY
    ranges = []
    for i, p in enumerate(probs):
        lo = F.when(whole | F.lit(p - MARGIN <= 0.0), field("min")).otherwise(F.get(field("q"), F.lit(i)))
        hi = F.when(whole | F.lit(p + MARGIN >= 1.0), field("max")).otherwise(F.get(field("q"), F.lit(len(probs) + i)))
        ranges.append((lo, hi))
    return field("n"), ranges


def _between(pair: Column, place: Column) -> Column:
    """Linear interpolation between the values of the two ranks around a place."""
    share = place - F.floor(place)
    # On a rank, and between equal values, infinite ones included, there is nothing to interpolate.
    value = F.when((share == 0) | (pair["lo"] == pair["hi"]), pair["lo"]).otherwise(pair["lo"] + (pair["hi"] - pair["lo"]) * share)
    missed = pair["lo"].isNull() | pair["hi"].isNull()
    return F.when(missed, F.raise_error(F.lit("quantile rank outside its bracket")).cast("double")).otherwise(value)


def quantile_columns(df: DataFrame, column: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles of one column, one output column per named probability, one row per group."""
    long = exact_quantiles(df, [column], sorted(set(probs.values())), by)
    return long.groupBy(*by).agg(*[
        F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(n) for n, p in probs.items()])


def stretch(df: DataFrame, column: str, by: Sequence[str], low: float, high: float, out: str) -> DataFrame:
    """Values rescaled so that the group's low and high quantile become 0 and 1, clipped outside.

    The two quantiles per group are written and joined back: few groups are copied to the rows,
    which are not shuffled; many are joined on the group and a salt, so a group with most
    of the rows is dealt over many tasks. A null value stays null, and so do the values of a
    group that has none; null is a group. A column named out is replaced.
    """
    limits = stored(quantile_columns(df, column, {"_p_lo": low, "_p_hi": high}, by), "limits")
    width = F.greatest(F.col("_p_hi") - F.col("_p_lo"), F.lit(1e-9))
    scaled = F.least(F.greatest((F.col(column) - F.col("_p_lo")) / width, F.lit(0.0)), F.lit(1.0))
    value = F.when(F.col(column).isNotNull() & F.col("_p_lo").isNotNull(), scaled)
    # Rows of a group are dealt over SALTS join keys, and so is its one row of limits.
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    limits = limits.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)], "_p_lo", "_p_hi",
                           F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("_part"))
    match = F.col("_salt") == F.col("_part")
    for i, k in enumerate(by):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return salted.join(limits, match, "left").withColumn(out, value).select(*[c for c in df.columns if c != out], out)
