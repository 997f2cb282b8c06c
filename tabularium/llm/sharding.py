"""Sharding by extendible hashing, in DataFrame operations only.

Every row has a bit path: 64 bits of md5 of its key, then bits of md5 of its place in the scan, so that even one key that
holds a third of all rows can be split. A bucket is a prefix of that path. A bucket over the byte limit splits on one more
bit; the others stay. Sizes are summed for 16 bits at once: the sums of all shallower prefixes follow from those of at
most 65,536 cells per oversized parent, so a round costs one pre-aggregated shuffle however large the table is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.session import stored

#: Bits per round, and hex digits for them.
BITS, DIGITS = 16, 4
#: Hex digits of the whole path: 64 bits of the key and 64 of the place.
PATH_DIGITS = 32


def bit_path(key: str) -> Column:
    """The hex path of a row; a null key counts as a key of its own."""
    by_key = F.md5(F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null")))
    by_place = F.md5(F.monotonically_increasing_id().cast("string"))
    return F.concat(F.substring(by_key, 1, 16), F.substring(by_place, 1, 16))


def extendible_shards(df: DataFrame, key: str, n_bytes: Column, limit: int) -> DataFrame:
    """Rows with the shard of each: key, n_bytes, shard (its prefix bits), shard_bits, shard_bytes.

    A shard exceeds the limit only where a single row does. Null sizes count as 0. An empty table gives no rows; repeated
    rows are rows of their own. Other columns of df are not carried, so clashing names do no harm.
    """
    if limit < 1:
        raise ValueError("limit must be positive")
    rows = stored(df.select(F.col(key).alias("__key"), F.coalesce(n_bytes, F.lit(0)).cast("long").alias("__size"),
                            bit_path(key).alias("__path")), "shard-rows")
    open_rows, done = rows, []
    for step in range(PATH_DIGITS // DIGITS):
        taken = step * DIGITS
        cells = (open_rows.groupBy(F.substring("__path", 1, taken + DIGITS).alias("__cell"))
                 .agg(F.sum("__size").alias("__size"), F.count(F.lit(1)).alias("__rows")))
        levels = cells.select(
            "__cell", "__size", "__rows", F.substring("__cell", 1, taken).alias("__parent"),
            F.lpad(F.bin(F.conv(F.substring("__cell", taken + 1, DIGITS), 16, 10).cast("long")), BITS, "0").alias("__bits"),
            F.explode(F.sequence(F.lit(0 if step == 0 else 1), F.lit(BITS))).alias("__depth"),
        ).withColumn("__node", F.expr("substring(__bits, 1, __depth)"))
        sums = levels.groupBy("__parent", "__node").agg(F.sum("__size").alias("__total"), F.sum("__rows").alias("__n"))
        fits = (F.col("__total") <= limit) | (F.col("__n") == 1)
        directory = stored(
            levels.join(sums, ["__parent", "__node"])
            .groupBy("__cell", "__parent").agg(F.min(F.when(fits, F.struct("__depth", "__node", "__total"))).alias("__leaf"))
            .select("__cell", "__parent", "__leaf.*"), "shard-directory")
        placed = open_rows.withColumn("__cell", F.substring("__path", 1, taken + DIGITS)).join(directory, "__cell")
        done.append(placed.where(F.col("__depth").isNotNull()).select(
            "__key", "__size", F.concat(_binary("__parent", taken), "__node").alias("shard"),
            (F.col("__depth") + taken * 4).cast("int").alias("shard_bits"), F.col("__total").alias("shard_bytes")))
        if not directory.where(F.col("__depth").isNull()).limit(1).count():
            break
        open_rows = stored(placed.where(F.col("__depth").isNull()).select("__key", "__size", "__path"), "shard-open")
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.select(F.col("__key").alias(key), F.col("__size").alias("n_bytes"), "shard", "shard_bits", "shard_bytes")


def _binary(column: str, digits: int) -> Column:
    """A hex prefix as bits."""
    parts = [F.lpad(F.bin(F.conv(F.substring(column, i, DIGITS), 16, 10).cast("long")), BITS, "0")
             for i in range(1, digits + 1, DIGITS)]
    return F.concat(*parts) if parts else F.lit("")
