"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import stored

#: Rounds after which the job fails instead of returning unfinished components; the rounds needed grow with the logarithm.
MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node that has a link; component is the smallest node reachable, itself included.

    Links with a null end or to oneself count for nothing; repeated and reversed links count once; no link gives no row.
    Each round is a pre-aggregated minimum and a join on the node, both of which tolerate a hot node; only a count and a
    checksum reach the driver, and each round's links are written to the shared folder.
    """
    edges = stored(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
                   .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "links")
    before = _state(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 linked by pairs (a, b): the smallest node that each reaches."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        label = new[label]
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label
