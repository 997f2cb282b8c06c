"""Composition of sequences, contiguity of assemblies and density of genes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.operators.indexing import running_total


def composition(df: DataFrame, sequence: str, by: Sequence[str] = (), background: Mapping[str, float] | None = None) -> DataFrame:
    """(by..., residue, n, share, enrichment): how often each letter occurs, as upper case; only A-Z and a-z count.

    enrichment is the base 2 logarithm of the share over the background share, null for letters without one. Letters are
    counted inside the tasks, so a group of most sequences sends a row per letter and task.
    """
    letters = F.explode(F.regexp_extract_all(F.col(sequence), F.lit("([A-Za-z])"), 1))
    counts = df.select(*by, letters.alias("residue")).withColumn("residue", F.upper("residue")).groupBy(*by, "residue").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    known = F.create_map(*[x for k, v in (background or {}).items() for x in (F.lit(k), F.lit(float(v)))]) if background else None
    enrichment = F.log2(F.col("share") / F.try_element_at(known, F.col("residue"))) if background else F.lit(None).cast("double")
    return counts.withColumn("share", share).withColumn("enrichment", enrichment).select(*by, "residue", "n", "share", "enrichment")


def contiguity(df: DataFrame, length: str, by: Sequence[str], share: float = 0.5) -> DataFrame:
    """(by..., n_pieces, total, longest, n_length, n_pieces_to): the N50 family for share 0.5.

    n_length is the length at which pieces, longest first, reach the share of the total, n_pieces_to how many that takes.
    Lengths that are null or not positive are left out. Equal lengths are folded, and a range-partitioned running total
    puts an assembly over many tasks.
    """
    by = list(by)
    folded = df.where(F.col(length) > 0).groupBy(*by, F.col(length).cast("bigint").alias("_length")).agg(F.count("*").alias("_n"))
    folded = folded.select(*by, "_n", (-F.col("_length")).alias("_minus"), (F.col("_length") * F.col("_n")).alias("_sum"))
    running = running_total(folded, by, ["_minus"], "_sum", "_upto")
    totals = folded.groupBy(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(by)]).agg(
        F.sum("_n").alias("n_pieces"), F.sum("_sum").alias("total"), (-F.min("_minus")).alias("longest"))
    match = F.lit(True)
    for i, k in enumerate(by):
        match = match & F.col(k).eqNullSafe(F.col(f"_b{i}"))
    joined = running.join(totals, match)
    goal = F.col("total") * F.lit(share)
    before = F.col("_upto") - F.col("_sum")
    reached = joined.groupBy(*by, "n_pieces", "total", "longest").agg(
        (-F.min(F.when(F.col("_upto") >= goal, F.col("_minus")))).alias("n_length"),
        F.sum(F.when(F.col("_upto") < goal, F.col("_n")).when(before < goal, F.ceil((goal - before) / -F.col("_minus")))).alias("n_pieces_to"))
    return reached.select(*by, "n_pieces", "total", "longest", "n_length", F.greatest("n_pieces_to", F.lit(1)).cast("bigint").alias("n_pieces_to"))


def gene_density(df: DataFrame, region: str, start: str, end: str, width: int) -> DataFrame:
    """(region, bin, bin_start, n_genes, covered, share): genes per window and the positions that any of them covers.

    Positions count from 1 and intervals include both ends. A gene counts in every window that it touches; it is cut at the
    window borders, so overlaps are merged inside a window alone and no task holds a region. Intervals with a null, or whose
    end lies before their start, are left out; windows without a gene have no row.
    """
    rows = df.where((F.col(region).isNotNull()) & (F.col(start) >= 1) & (F.col(end) >= F.col(start))).select(
        F.col(region).alias("region"), F.col(start).cast("bigint").alias("_s"), F.col(end).cast("bigint").alias("_e"))
    # Whole-number division: a quotient in doubles is rounded up beyond 2^43 windows.
    first, last = (F.expr(f"({c} - 1) div {int(width)}") for c in ("_s", "_e"))
    cut = rows.select("region", "_s", "_e", F.explode(F.sequence(first, last)).alias("bin"))
    low, high = F.col("bin") * width + 1, (F.col("bin") + 1) * width
    pieces = cut.select("region", "bin", F.greatest("_s", low).alias("_s"), F.least("_e", high).alias("_e")).groupBy("region", "bin", "_s", "_e").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("region", "bin").orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("_e").over(before), F.lit(0))
    fresh = pieces.withColumn("_new", F.greatest(F.lit(0), F.col("_e") - F.greatest(F.col("_s") - 1, reach)))
    return fresh.groupBy("region", "bin").agg(F.sum("_n").alias("n_genes"), F.sum("_new").cast("bigint").alias("covered")).select(
        "region", "bin", (F.col("bin") * width + 1).alias("bin_start"), "n_genes", "covered", (F.col("covered") / F.lit(width)).alias("share"))
