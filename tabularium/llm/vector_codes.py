"""Vector code compression: product codes whose nearest entries are found by equal-average search.

Vectors become integers and are cut into equal parts; each part is coded by the nearest entry of its position's codebook.
The squared gap between two component sums is at most the squared distance times the dimension, so entries are sorted by
sum and tried outward from the part's own sum until that gap alone exceeds the best distance found. Codebooks are refined
in rounds: every task adds up the parts of each entry, and only these sums reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabularium.session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def finite(vector: Column) -> Column:
    """Whether a vector is neither null nor holds a null or non-finite component."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the nearest row of entries by squared distance, ties to the lower index, and that distance."""
    order = np.lexsort((np.arange(len(entries)), entries.sum(axis=1)))
    sums, width = entries.sum(axis=1)[order], x.shape[1]
    own = x.sum(axis=1)
    up = np.searchsorted(sums, own)  # the next entry to try above, and below
    down = up - 1
    best = np.full(len(x), np.iinfo(np.int64).max)
    at = np.full(len(x), len(entries))
    live = np.arange(len(x))
    far = np.int64(np.iinfo(np.int64).max)
    for _ in range(len(entries)):
        above = np.where(up[live] < len(sums), sums[np.minimum(up[live], len(sums) - 1)] - own[live], far)
        below = np.where(down[live] >= 0, own[live] - sums[np.maximum(down[live], 0)], far)
        rise = above <= below
        gap = np.where(rise, above, below)
        going = (best[live] == far) | (gap * gap <= best[live] * width)
        live, rise = live[going], rise[going]
        if not len(live):
            break
        entry = order[np.where(rise, up[live], down[live])]
        up[live] += rise
        down[live] -= ~rise
        apart = x[live] - entries[entry]
        distance = np.einsum("ij,ij->i", apart, apart)
        better = (distance < best[live]) | ((distance == best[live]) & (entry < at[live]))
        best[live[better]], at[live[better]] = distance[better], entry[better]
    return at, best


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def refine(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floored means of the parts nearest to them; entries without a part stay."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), parts * width)
            for p in range(parts):
                part = x[:, p * width:(p + 1) * width]
                at, _ = nearest(part, books[p])
                np.add.at(total[p, :, :width], at, part)
                total[p, :, width] += np.bincount(at, minlength=entries)
        flat = total.ravel()
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_pydict({"place": some, "value": flat[some]})

    total = np.zeros(parts * entries * (width + 1), np.int64)
    for row in vectors.select("vector").mapInArrow(add, "place long, value long").groupBy("place").agg(F.sum("value").alias("value")).collect():
        total[row["place"]] = row["value"]
    total = total.reshape(parts, entries, width + 1)
    count = total[:, :, width:]
    return np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimal text joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, key: str, vector: str, label: str, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """Codes of the vectors as rows (key, label, code, error), and the codebooks (parts, entries, components).

    Rows whose vector is null or holds null or non-finite components are dropped. Codebooks start from the vectors of the
    smallest keys, null keys last and equal keys by their vectors; fewer rows than entries give smaller codebooks, and no row
    gives none. code has two hex digits per part; error is the sum of the squared distances of the integer parts. Repeated
    rows are coded alike; null keys and labels stay; other columns are not carried. Vectors of different lengths, a length that
    the number of parts does not divide, and components so large that distances leave 64 bits are a ValueError. A round brings
    parts * entries * (components + 1) sums to the driver at most; a task holds one Arrow batch.
    """
    c = F.col(vector)
    vectors = stored(df.where(finite(c)).select(F.col(key).alias("key"), F.col(label).alias("label"),
                                                F.transform(c, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("vector")), "code-vectors")
    size = F.size("vector")
    low, high, peak = vectors.agg(F.min(size), F.max(size), F.max(F.greatest(F.array_max("vector").cast("double"), -F.array_min("vector").cast("double")))).first()
    if low != high:
        raise ValueError(f"vectors have {low} to {high} components")
    dims = low or 0
    if dims % parts:
        raise ValueError(f"{dims} components cannot be cut into {parts} equal parts")
    width = dims // parts
    if 2 * max(1, width) * ((peak or 0.0) + 1) >= 2 ** 31:
        raise ValueError("components are too large for distances of 64 bits")
    first = vectors.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).collect()
    books = np.array([r["vector"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    kind = {f.name: f.dataType for f in vectors.schema}
    shape = StructType([StructField("key", kind["key"]), StructField("label", kind["label"]), StructField("code", StringType()), StructField("error", LongType())])
    for _ in range(rounds if len(first) else 0):
        books = refine(vectors, books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), dims)
            found = [nearest(x[:, p * width:(p + 1) * width], books[p]) for p in range(parts)]
            codes = np.stack([at for at, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([row.tobytes().hex() for row in codes], pa.string()),
                                              pa.array(sum(far for _, far in found), pa.int64())], ["key", "label", "code", "error"])

    if not len(first):
        return df.sparkSession.createDataFrame([], shape), books
    return stored(vectors.mapInArrow(code, shape), "codes"), books


def code_report(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """key, code, error, label_error (error summed over equal labels, nulls together) and codebooks_sha256; see compress.

    The sums by label are pre-aggregated in the tasks, so a label of most rows costs one row a task.
    """
    codes, books = compress(df, key, vector, label)
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (codes.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .select(F.col("key").alias(key), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
