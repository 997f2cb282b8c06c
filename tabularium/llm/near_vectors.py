"""Embedding near-duplicates by PCA-ordered tiled comparison.

Equal vectors are folded into one first. The others are turned into the order of their principal components and cut into
blocks along the first one: vectors further apart there than the threshold allows are never paired. A task compares two
blocks in tiles: one product gives the sum over the leading components plus the product of the norms of what is left, which
bounds the rest, and drops every pair that cannot reach the threshold. What is left is decided by the cosine of the original
vectors in double precision, and its links are folded into counts and a forest as they are found.

Comparing all rows is quadratic where the first component does not separate them. A vector is shuffled once per block that it
may have a partner in, and blocks grow with the table up to a size in bytes, so copies stay few. A task's memory is two blocks,
a tile and a bounded number of pairs, whatever the number of blocks and of links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.llm.components import connected, forest
from tabularium.session import stored

#: Vectors in a block and in the side of a tile.
BLOCK, TILE = 4096, 1024
#: Blocks of a table from which on they grow instead of becoming more, and the bytes of vectors up to which they grow.
BLOCKS, BLOCK_BYTES = 8, 16 << 20
#: Leading components of the bound, and its slack for rounding in single precision; the decision itself has none.
LEADING, SLACK = 32, 2e-5
#: Components of pairs that are decided at once, pairs that are folded at once, and bytes that a batch of dealt rows has at most.
DECIDED, FOLDED, DEALT_BYTES = 1 << 21, 1 << 19, 8 << 20


def usable(vector: str) -> Column:
    """Whether a vector can link at all: not null, not empty, all components finite, not zero."""
    c = F.col(vector)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and axes (as columns, the widest first) of all unit vectors; dims * (dims + 1) sums reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims))
        n = 0
        for batch in batches:
            x = _unit(_matrix(batch.column(0), dims))
            total[:dims] += x.T @ x
            total[dims] += x.sum(axis=0)
            n += len(x)
        flat = np.append(total.ravel(), n)
        yield pa.RecordBatch.from_pydict({"place": np.arange(len(flat)), "value": flat})

    parts = vectors.select("vector").mapInArrow(sums, "place long, value double")
    flat = np.zeros(dims * (dims + 1) + 1)
    for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
        flat[r["place"]] = r["value"]
    n = max(1.0, flat[-1])
    moment, mean = flat[:dims * dims].reshape(dims, dims) / n, flat[dims * dims:-1] / n
    _, axes = np.linalg.eigh(moment - np.outer(mean, mean))
    return mean, axes[:, ::-1]


def _leads(x: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: leading components and the norm of the rest, the first component, the square of its length."""
    lead, squares = np.empty((len(x), min(LEADING, axes.shape[1]) + 1), np.float32), np.empty(len(x))
    first = np.empty(len(x))
    for i in range(0, len(x), TILE):
        rows = x[i:i + TILE].astype(np.float64)
        turned = _unit(rows) @ axes[:, :LEADING]
        lead[i:i + TILE, :-1], lead[i:i + TILE, -1] = turned, np.sqrt(np.maximum(0.0, 1 - (turned ** 2).sum(axis=1)))
        first[i:i + TILE], squares[i:i + TILE] = turned[:, 0], np.einsum("ij,ij->i", rows, rows)
    return lead, first, squares


def near(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of two matrices whose cosine reaches the threshold, in lists of bounded length; with same, each pair once and none with itself.

    Both matrices are in the order of the first component, so a tile meets only rows within the threshold's reach of it.
    """
    spread = _spread(threshold)
    la, fa, sa = _leads(a, axes)
    lb, fb, sb = (la, fa, sa) if same else _leads(b, axes)
    at_once = max(1, DECIDED // a.shape[1])
    for i in range(0, len(a), TILE):
        end = min(i + TILE, len(a))
        start, stop = np.searchsorted(fb, fa[i] - spread), np.searchsorted(fb, fa[end - 1] + spread, "right")
        for j in range(max(i, start) if same else start, stop, TILE):
            to = min(j + TILE, stop)
            found = np.flatnonzero((la[i:end] @ lb[j:to].T).ravel() >= threshold - SLACK)
            for part in range(0, len(found), at_once):
                r, c = np.divmod(found[part:part + at_once], to - j)
                r, c = r + i, c + j
                if same:
                    r, c = r[r < c], c[r < c]
                dots = np.einsum("ij,ij->i", a[r].astype(np.float64), b[c].astype(np.float64))
                go = dots / np.sqrt(sa[r] * sb[c]) >= threshold
                if go.any():
                    yield r[go], c[go]


def _spread(threshold: float) -> float:
    """How far apart along any axis two unit vectors can be that reach the threshold."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK


def near_vectors(df: DataFrame, key: str, vector: str, threshold: float = 0.95) -> DataFrame:
    """One row per row of df: key, n_links, component_id, kept.

    Null, empty or zero vectors and those with null or non-finite components have no links, and neither do vectors of
    different lengths. A row with a null key counts as a link of others but has no name: it is never a component_id unless
    all of its component are null, and then kept is false. Repeated rows are rows of their own. An empty table gives no
    rows. Other columns are not carried.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    rows = df.select(F.col(key).alias("__key"), F.col(vector).alias("__vector"))
    # Single precision is kept until a task compares: half the bytes of a double.
    kind = "float" if isinstance(rows.schema["__vector"].dataType.elementType, T.FloatType) else "double"
    ok = rows.where(usable("__vector")).select("__key", F.transform("__vector", lambda x: x.cast(kind) + F.lit(0.0).cast(kind)).alias("vector"))
    mark = F.xxhash64("vector")
    folded = stored(ok.groupBy("vector").agg(F.min("__key").alias("low"), F.count(F.lit(1)).alias("copies"))
                    .select(mark.alias("v"), F.size("vector").alias("dims"), "low", "copies", "vector"), "vectors")
    lengths = sorted(r["dims"] for r in folded.select("dims").distinct().collect())
    found = None
    for dims in lengths:
        part = _compare(folded.where(F.col("dims") == dims), dims, threshold)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select(F.col("__key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("__key").alias("component_id"),
                           F.coalesce(F.col("__key").isNotNull(), F.lit(False)).alias("kept"))
    found = stored(found, "vector-links")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("v")).agg(F.sum("b").alias("others"))
    parts = connected(found.where("kind = 1"), "a", "b").withColumnRenamed("node", "v")
    known = folded.select("v", "low", "copies").join(counts, "v", "left").join(parts, "v", "left").withColumn("component", F.coalesce("component", "v"))
    lows = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = known.join(lows, "component").select("v", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    named = ok.select("__key", mark.alias("v")).join(known, "v").drop("v")
    rest = rows.where(~usable("__vector")).select("__key", F.lit(0).cast("long").alias("n_links"), F.col("__key").alias("component_id"))
    return named.union(rest).select(F.col("__key").alias(key), F.col("n_links").cast("long").alias("n_links"), "component_id",
                                    F.coalesce(F.col("__key") == F.col("component_id"), F.lit(False)).alias("kept"))


def _batches(row: np.ndarray, per: int) -> Iterator[np.ndarray]:
    """Row numbers in runs of at most per."""
    for i in range(0, len(row), per):
        yield row[i:i + per]


def _compare(folded: DataFrame, dims: int, threshold: float) -> DataFrame:
    """(kind, a, b): kind 0 adds b links to vector a; kind 1 is a link of a forest that spans the links found in a task."""
    mean, axes = principal_axes(folded, dims)
    spread = _spread(threshold)
    n = folded.count()
    first = axes[:, 0]
    vector = folded.schema["vector"].dataType.simpleString()
    width = 4 if "float" in vector else 8

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"v": batch.column(0), "place": _unit(_matrix(batch.column(2), dims)) @ first, "copies": batch.column(1), "vector": batch.column(2)})

    placed = folded.select("v", "copies", "vector").mapInArrow(along, f"v long, place double, copies long, vector {vector}")
    blocks = max(1, -(-n // max(1, BLOCK_BYTES // (width * dims))), min(BLOCKS, -(-n // BLOCK)))
    cuts = np.array(placed.approxQuantile("place", [i / blocks for i in range(1, blocks)], 0.2 / blocks)) if blocks > 1 else np.empty(0)
    # Block i holds places in (cuts[i-1], cuts[i]]; pairs reach as far as the spread.
    lows, highs = np.append(-np.inf, cuts), np.append(cuts, np.inf)
    per = max(1, DEALT_BYTES // (width * dims + 48))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.asarray(batch.column(1))
            home = np.searchsorted(cuts, place, "left")
            start = np.searchsorted(highs, lows[home] - spread, "left")
            end = np.searchsorted(lows, highs[home] + spread, "right")
            times = end - start
            row = np.repeat(np.arange(len(home)), times)
            other = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + start[row]
            # Across blocks only those near the border can have a partner.
            go = (other == home[row]) | ((place[row] >= lows[other] - spread) & (place[row] <= highs[other] + spread))
            for at in _batches(np.flatnonzero(go), per):
                r, o = row[at], other[at]
                taken = batch.take(pa.array(r))
                i, j = np.minimum(home[r], o), np.maximum(home[r], o)
                yield pa.RecordBatch.from_pydict({
                    "pair": (i * blocks + j - i * (i + 1) // 2).astype(np.int32), "same": i == j, "at_home": home[r] == i,
                    "v": taken.column(0), "place": taken.column(1), "copies": taken.column(2), "vector": taken.column(3)})

    dealt = placed.mapInArrow(deal, f"pair int, same boolean, at_home boolean, v long, place double, copies long, vector {vector}")

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        same, at_home, v, place, copies = (rows[c].to_numpy() for c in ("same", "at_home", "v", "place", "copies"))
        x = _matrix(rows["vector"], dims)
        order = np.argsort(place, kind="stable")
        left = order[at_home[order]]
        right = left if same[0] else order[~at_home[order]]
        links, label = np.zeros(len(v), np.int64), np.arange(len(v))
        if len(left) and len(right):
            waiting: list[tuple[np.ndarray, np.ndarray]] = []
            held = 0
            for r, c in near(x[left], x[right], axes, threshold, bool(same[0])):
                r, c = left[r], right[c]
                np.add.at(links, r, copies[c])
                np.add.at(links, c, copies[r])
                waiting.append((r, c))
                held += len(r)
                if held >= FOLDED:
                    label, waiting, held = _joined(label, waiting), [], 0
            label = _joined(label, waiting)
        with_links = np.flatnonzero(links)
        joined = np.flatnonzero(label != np.arange(len(v)))
        return pa.table({"kind": np.repeat(np.array([0, 1], np.int64), [len(with_links), len(joined)]), "a": np.concatenate([v[with_links], v[joined]]),
                         "b": np.concatenate([links[with_links], v[label[joined]]])})

    # A task for every two blocks, none for two pairs of them.
    return dealt.repartitionById(blocks * (blocks + 1) // 2, F.col("pair")).groupBy("pair").applyInArrow(compare, "kind long, a long, b long")


def _joined(label: np.ndarray, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The labels of a forest when more links are known."""
    if not links:
        return label
    a, b = (label[np.concatenate(x)] for x in zip(*links, strict=True))
    return forest(len(label), a[a != b], b[a != b])[label]
