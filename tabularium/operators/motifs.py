"""Count matrices of sequence motifs: log-odds, information content and similarity, inside the row.

A matrix is an array of positions, each an array of four counts in the order A, C, G, T.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIFORM = (0.25, 0.25, 0.25, 0.25)


def positions(a: Column, c: Column, g: Column, t: Column) -> Column:
    """Four lists of counts, one per base, as one matrix; null unless all are there and equally long."""
    equal = (F.size(a) == F.size(c)) & (F.size(a) == F.size(g)) & (F.size(a) == F.size(t))
    return F.when(equal, F.transform(F.arrays_zip(a.alias("a"), c.alias("c"), g.alias("g"), t.alias("t")),
                                     lambda p: F.array(*[p[b].cast("double") for b in "acgt"])))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)


def _shares(counts: Column, pseudo: float, background: Sequence[float]) -> Column:
    """Shares of the bases at a position, with pseudocounts in proportion to the background."""
    total = _total(counts) + F.lit(float(pseudo))
    return F.transform(F.arrays_zip(counts.alias("n"), F.array(*[F.lit(float(b)) for b in background]).alias("b")), lambda x: F.try_divide(x["n"] + F.lit(float(pseudo)) * x["b"], total))


def log_odds(matrix: Column, pseudo: float = 0.8, background: Sequence[float] = UNIFORM) -> Column:
    """Position weight matrix: base 2 logarithm of a base's share over its background."""
    odds = lambda p: F.transform(F.arrays_zip(p.alias("p"), F.array(*[F.lit(float(b)) for b in background]).alias("b")), lambda x: F.log2(x["p"] / x["b"]))
    return F.transform(matrix, lambda counts: odds(_shares(counts, pseudo, background)))


def information(matrix: Column) -> Column:
    """Bits per position: 2 minus the entropy of the shares; a position without counts is null."""
    entropy = lambda p: _total(F.transform(p, lambda x: F.when(x > 0, -x * F.log2(x)).when(x == 0, 0.0)))
    return F.transform(matrix, lambda counts: 2 - entropy(_shares(counts, 0.0, UNIFORM)))


def reverse_complement(matrix: Column) -> Column:
    """The motif on the other strand: positions and, as A pairs with T and C with G, bases in reverse."""
    return F.transform(F.reverse(matrix), lambda counts: F.reverse(counts))


def _alike(x: Column, y: Column) -> Column:
    """Pearson correlation of two positions' shares, 0 where one is flat."""
    zipped = F.transform(F.arrays_zip(x.alias("x"), y.alias("y")), lambda p: F.struct((p["x"] - 0.25).alias("x"), (p["y"] - 0.25).alias("y")))
    add = lambda f: F.aggregate(zipped, F.lit(0.0), lambda s, p: s + f(p))
    return F.coalesce(F.try_divide(add(lambda p: p["x"] * p["y"]), F.sqrt(add(lambda p: p["x"] * p["x"]) * add(lambda p: p["y"] * p["y"]))), F.lit(0.0))


def similarity(first: Column, second: Column, least: int = 3) -> Column:
    """(score, offset, strand): the best mean correlation of positions over all alignments without gaps and both strands.

    The second motif starts at position offset of the first, on strand '+' or reversed and complemented, '-'. At least so
    many positions overlap, or all of the shorter motif. Of equal scores, to nine digits, the longer overlap wins, then '+'
    and the smaller offset. Null where a motif is null or empty.
    """
    shares = lambda m: F.transform(m, lambda counts: F.transform(_shares(counts, 0.0, UNIFORM), lambda x: F.coalesce(x, F.lit(0.25))))

    def search(a: Column, b: Column, back: Column) -> Column:
        n, m = F.size(a), F.size(b)
        overlap = F.least(F.lit(least), n, m)

        def aligned(other: Column, strand: str) -> Column:
            def at(offset: Column) -> Column:
                start, end = F.greatest(offset, F.lit(0)), F.least(n, offset + m)
                each = F.transform(F.sequence(start, end - 1), lambda i: _alike(F.get(a, i), F.get(other, i - offset)))
                mean = _total(each) / (end - start)
                return F.struct((-F.round(mean, 9)).alias("minus"), (start - end).alias("length"), F.lit(strand).alias("strand"), offset.alias("offset"))
            return F.transform(F.sequence(overlap - m, n - overlap), at)

        best = F.array_min(F.concat(aligned(b, "+"), aligned(back, "-")))
        return F.struct((-best["minus"]).alias("score"), best["offset"].alias("offset"), best["strand"].alias("strand"))

    # A list of one makes the shares values of the function below, so they are not worked out again for each alignment.
    bound = F.array(F.struct(shares(first).alias("a"), shares(second).alias("b")))
    usable = first.isNotNull() & second.isNotNull() & (F.size(first) > 0) & (F.size(second) > 0)
    return F.when(usable, F.get(F.transform(bound, lambda s: search(s["a"], s["b"], reverse_complement(s["b"]))), F.lit(0)))
