"""Hierarchies held as edge tables (child_id, parent_id, relation)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import cut_lineage


def of_relation(edges: DataFrame, relation: str) -> DataFrame:
    """Edges of one relation."""
    return edges.filter(F.col("relation") == relation)


def descendants(edges: DataFrame, roots: DataFrame, relation: str = "is_a", fold_every: int = 10) -> DataFrame:
    """All nodes below the roots over one relation: (id, depth of the first visit).

    ``roots`` has a column ``id``. The walk goes level by level: the edges whose parent is on
    the frontier give the next level, minus everything visited. Graphs with shared children
    and cycles end, because a node enters once; a root is in the result only if a cycle leads
    back to it. Each level is written to the shared folder, so a lost executor costs one
    level; the levels are folded into one table every ``fold_every`` rounds to keep the plan
    short. Only whether a level is empty reaches the driver.
    """
    # Dealt by parent once; the checkpoint keeps the partitioning, so the joins below move the frontier only.
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    down = cut_lineage(of_relation(edges, relation).select("parent_id", "child_id").distinct().repartition(parts, "parent_id"))
    frontier = roots.select("id").distinct()
    visited: DataFrame | None = None
    depth = 0
    while True:
        depth += 1
        step = down.join(frontier, down["parent_id"] == frontier["id"], "left_semi").select(F.col("child_id").alias("id")).distinct()
        if visited is not None:
            step = step.join(visited, "id", "left_anti")
        level = cut_lineage(step.select("id", F.lit(depth).alias("depth")))
        if level.isEmpty():
            break
        visited = level if visited is None else visited.unionByName(level)
        if depth % fold_every == 0:
            visited = cut_lineage(visited)
        frontier = level.select("id")
    return visited if visited is not None else level


def induced_edges(edges: DataFrame, nodes: DataFrame, relation: str = "is_a") -> DataFrame:
    """Edges of one relation with both ends in the node set (a column ``id``)."""
    kept = of_relation(edges, relation)
    ids = nodes.select("id").distinct()
    return (kept.join(ids.withColumnRenamed("id", "child_id"), "child_id", "left_semi")
                .join(ids.withColumnRenamed("id", "parent_id"), "parent_id", "left_semi")
                .select(*edges.columns))


def with_roots(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Node set with the roots added, each id once."""
    return nodes.select("id").union(roots.select("id")).distinct()


def adjacency(edges: DataFrame, relation: str = "is_a") -> DataFrame:
    """Edges of a relation as a clustered parent-to-child table with the parent's fan-out.

    A parent may have any number of children, so children stay rows; the fan-out is a
    partial count joined on the parent.
    """
    kept = of_relation(edges, relation).select("parent_id", "child_id").distinct()
    fan_out = kept.groupBy("parent_id").agg(F.count("*").alias("n_children"))
    return kept.join(fan_out, "parent_id")
