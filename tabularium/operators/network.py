"""Measures of an undirected network held as a table of edges (a, b) with a < b."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.session import stored

#: Rounds after which components fail instead of coming out unfinished; those needed grow with the logarithm of the nodes.
MAX_ROUNDS = 60


def undirected(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Each pair of different nodes once, the smaller first; rows with a null end are no edges."""
    ends = edges.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"), (F.col(left) != F.col(right)).alias("_two"))
    return ends.where("_two").select("a", "b").distinct()


def both_ways(pairs: DataFrame) -> DataFrame:
    """Every edge in both directions."""
    return pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def degrees(pairs: DataFrame) -> DataFrame:
    """(node, degree) of every node with an edge. Counts are partial sums, so a hub costs one row per task."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    return ends.groupBy("node").agg(F.count("*").alias("degree"))


def degree_distribution(pairs: DataFrame) -> DataFrame:
    """(degree, n_nodes, share_at_least): the last is the share of nodes with that degree or a higher one.

    As many rows as there are different degrees, at most the root of twice the number of edges, so one window orders them.
    """
    counts = degrees(pairs).groupBy("degree").agg(F.count("*").alias("n_nodes"))
    upward = Window.orderBy(F.col("degree").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.select("degree", "n_nodes", (F.sum("n_nodes").over(upward) / F.sum("n_nodes").over(everything)).alias("share_at_least"))


def hubs(pairs: DataFrame, deviations: float = 2.0) -> DataFrame:
    """Nodes whose degree is at least the mean plus so many standard deviations: (node, degree, z)."""
    found = degrees(pairs)
    mean, spread = found.agg(F.avg("degree"), F.stddev_pop("degree")).first()
    z = F.try_divide(F.col("degree") - F.lit(mean), F.lit(spread))
    return found.select("node", "degree", z.alias("z")).where(F.col("z") >= deviations)


def triangles(pairs: DataFrame) -> DataFrame:
    """(a, b, c): every triangle once.

    Edges point from the end of lower degree to that of higher degree, ties by name. No node then has more than the root of
    twice the number of edges going out, so paths over a hub do not grow with the square of its degree. Two edges out of a
    node make a path, and a path closes if its ends have an edge.
    """
    pairs = stored(pairs, "edges")
    return _triangles(pairs, stored(degrees(pairs), "degrees"))


def _triangles(pairs: DataFrame, degree: DataFrame) -> DataFrame:
    """The same for edges and degrees that are at hand."""
    first = degree.select(F.col("node").alias("a"), F.col("degree").alias("_da"))
    second = degree.select(F.col("node").alias("b"), F.col("degree").alias("_db"))
    known = pairs.join(first, "a").join(second, "b")
    up_first = F.struct("_da", "a") < F.struct("_db", "b")
    ends = (F.when(up_first, F.col(x)).otherwise(F.col(y)) for x, y in (("a", "b"), ("b", "a"), ("_db", "_da")))
    up = stored(known.select(*[e.alias(n) for e, n in zip(ends, ("u", "v", "d"), strict=True)]), "oriented-edges")
    paths = (up.select("u", "v", F.col("d").alias("_dv")).join(up.select("u", F.col("v").alias("w"), F.col("d").alias("_dw")), "u")
             .where((F.col("_dv") < F.col("_dw")) | (F.col("_dv") == F.col("_dw")) & (F.col("v") < F.col("w"))).select("u", "v", "w"))
    closed = paths.join(up.select(F.col("u").alias("v"), F.col("v").alias("w")), ["v", "w"], "left_semi")
    ordered = F.array_sort(F.array("u", "v", "w"))
    return closed.select(ordered[0].alias("a"), ordered[1].alias("b"), ordered[2].alias("c"))


def clustering(pairs: DataFrame) -> DataFrame:
    """(node, degree, n_triangles, coefficient): the share of a node's pairs of neighbours that are linked, 0 below degree 2."""
    # Edges are written, as all that follows reads them again.
    pairs = stored(pairs, "edges")
    degree = stored(degrees(pairs), "degrees")
    corners = _triangles(pairs, degree).select(F.explode(F.array("a", "b", "c")).alias("node")).groupBy("node").agg(F.count("*").alias("n_triangles"))
    counted = degree.join(corners, "node", "left").withColumn("n_triangles", F.coalesce("n_triangles", F.lit(0)))
    chances = F.col("degree") * (F.col("degree") - 1)
    return counted.withColumn("coefficient", F.coalesce(F.try_divide(2 * F.col("n_triangles"), chances), F.lit(0.0)))


def summary(pairs: DataFrame) -> DataFrame:
    """One row: nodes, edges, density, mean and highest degree, triangles, transitivity and mean clustering coefficient."""
    nodes = clustering(pairs)
    n, ends = F.count("*"), F.coalesce(F.sum("degree"), F.lit(0))
    around = F.sum(F.col("degree") * (F.col("degree") - 1) / 2)
    return nodes.agg(
        n.alias("n_nodes"), (ends / 2).cast("bigint").alias("n_edges"), F.try_divide(ends, n * (n - 1)).alias("density"),
        F.try_divide(ends, n).alias("mean_degree"), F.max("degree").alias("max_degree"),
        (F.coalesce(F.sum("n_triangles"), F.lit(0)) / 3).cast("bigint").alias("n_triangles"),
        F.try_divide(F.sum("n_triangles"), around).alias("transitivity"), F.avg("coefficient").alias("mean_clustering"))


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node that it reaches.

    Each node points at a node of its component, at first itself. In a round every node and the node that it points at take
    the smallest pointer that its neighbours' pointers have, and pointers are followed one step. Minima are pre-aggregated,
    rounds are written to the shared folder, and only whether a pointer changed reaches the driver.
    """
    links = stored(both_ways(pairs), "links")
    state = stored(links.select(F.col("a").alias("node")).distinct().withColumn("to", F.col("node")), "pointers")
    for _ in range(MAX_ROUNDS):
        ahead = state.select(F.col("node").alias("to"), F.col("to").alias("past"))
        followed = stored(state.join(ahead, "to"), "followed")
        seen = links.join(followed.select(F.col("node").alias("b"), "past"), "b").groupBy("a").agg(F.min("past").alias("least"))
        reach = followed.join(seen.withColumnRenamed("a", "node"), "node")
        hooked = reach.groupBy(F.col("to").alias("node")).agg(F.min("least").alias("hook"))
        new = reach.join(hooked, "node", "left").select("node", F.least("to", "past", "least", "hook").alias("new"), F.col("to").alias("old"))
        new = stored(new, "pointers")
        if new.where("new != old").isEmpty():
            return new.select("node", F.col("new").alias("component"))
        state = new.select("node", F.col("new").alias("to"))
    raise RuntimeError("components did not settle")


def communities(pairs: DataFrame, rounds: int = 10) -> DataFrame:
    """(node, community) by label propagation, the same on every run.

    Every node starts with its own name. In each of at most so many rounds all nodes at once take the name that most of
    their neighbours and they themselves have, the smallest of those as frequent; it ends early when nothing changes.
    Votes are counted per (node, name) first, so a hub's neighbours do not meet in one task.
    """
    links = stored(both_ways(pairs), "links")
    names = stored(links.select(F.col("a").alias("node")).distinct().withColumn("community", F.col("node")), "communities")
    for _ in range(rounds):
        votes = links.join(names.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "community").unionAll(names)
        counted = votes.groupBy("node", "community").agg(F.count("*").alias("n"))
        best = counted.groupBy("node").agg(F.min(F.struct((-F.col("n")).alias("n"), "community")).alias("best"))
        new = stored(best.select("node", F.col("best.community").alias("community")), "communities")
        changed = not new.join(names.withColumnRenamed("community", "old"), "node").where("community != old").isEmpty()
        names = new
        if not changed:
            break
    return names


def community_table(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """(community, n_nodes, n_inside, n_ends, modularity): edges inside, edge ends, and the community's share of modularity."""
    m = F.lit(pairs.count())
    ends = degrees(pairs).join(names, "node").groupBy("community").agg(F.count("*").alias("n_nodes"), F.sum("degree").alias("n_ends"))
    a, b = names.select(F.col("node").alias("a"), F.col("community").alias("_ca")), names.select(F.col("node").alias("b"), F.col("community").alias("_cb"))
    inside = (pairs.join(a, "a").join(b, "b").where("_ca = _cb").groupBy(F.col("_ca").alias("community")).agg(F.count("*").alias("n_inside")))
    table = ends.join(inside, "community", "left").withColumn("n_inside", F.coalesce("n_inside", F.lit(0)))
    share = F.col("n_inside") / m - F.pow(F.col("n_ends") / (2 * m), 2)
    return table.select("community", "n_nodes", "n_inside", "n_ends", share.alias("modularity"))
