"""Jaccard self-join of documents on word shingles, by rare-first prefix filtering.

1. One pass hashes the shingles of every text. It gives each document the digest of its set, so that equal sets become one
   node, and counts shingles in a fixed number of hash slots over all documents.
2. Shingles are ordered by the count of their slot, rare first, then by hash: a total order that all documents share. Of a
   set of n only the first n - ceil(t * n) + 1 can be the first one shared with a partner; these are the rows of the join.
3. In each group of a prefix shingle every member is paired with the group's smallest node, the pivot, if length and
   position allow. A node is verified against its smallest pivot first, which joins most copies in as many pairs as nodes.
4. In rounds, every group of which some nodes are not connected yet gets another pivot, by a hash of node and round, and a node
   outside the pivot's component is verified against one pivot. So nodes of a large group of near copies that miss one
   pivot meet another, and a round has at most one pair per open node. Rounds end when they connect few more.
5. The pairs still open in a group are made only between nodes that are not connected yet, again behind the length and
   positional filters, and each is verified once. So all links between classes are found, and copies are not expanded.

Before texts are fetched for a pair, a suffix filter bounds what the sets can have in common: a signature holds, per slice of
the hashes, whether the number of shingles is odd, and each slice where two signatures differ is a shingle that only one has.
It has two to four bits per shingle and never drops a similar pair. Verification groups pairs by pivot, salted
by the partner, and holds one pivot's set at a time. Only texts that a pair may want are shuffled for it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from tabularium.llm.batches import small_batches
from tabularium.llm.components import connected
from tabularium.llm.hashing import shingle_hashes
from tabularium.session import stored, stored_alone

#: Slots of the frequency table: its size does not depend on the data.
SLOT_BITS = 16
#: Partners of one pivot go to so many tasks at most.
SALTS = 64
#: A group over so many times the mean slot is split by node before pivots are chosen; the pivots of its parts meet after.
HOT, PARTS = 64, 32
#: Nodes in a block of a group of which pairs are made.
GROUP = 2000
#: Pairs looked at at once.
PAIRS = 1 << 20
#: Earlier open shingles that a row carries, so that a pair is made where it meets first.
EARLIER = 16
#: Bits that say which keys may be wanted: 1 MB on the driver and in a task, whatever the data.
WANTED_BITS = 1 << 23
#: Rounds of further pivots at most, and the share of a round's pairs that must link for another one to follow.
ROUNDS, YIELD = 4, 0.05


def digest(shingles: np.ndarray) -> int:
    """The node of a set; 64 bits, as an SQL long."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The smallest intersection with which sets of n and m reach the similarity: percent * union <= 100 * intersection."""
    return -((-percent * (n + m)) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -((-percent * n) // 100) + 1


def signature(shingles: np.ndarray) -> bytes:
    """The parities of the slices of a set, by the low bits of its hashes; a power of two of bits, 64 at least."""
    slices = 1 << max(6, (len(shingles) - 1).bit_length() + 1)
    odd = np.bincount((shingles & np.uint64(slices - 1)).astype(np.int64), minlength=slices) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def may_be_similar(n: int, a: bytes, m: int, b: bytes, percent: int) -> bool:
    """Whether two signatures leave it open that sets of n and m reach the similarity."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    p, q = 8 * len(a), 8 * len(b)
    while p > q:
        p //= 2
        x = (x >> p) ^ (x & ((1 << p) - 1))
    while q > p:
        q //= 2
        y = (y >> q) ^ (y & ((1 << q) - 1))
    return (x ^ y).bit_count() <= n + m - 2 * int(least_overlap(n, m, percent))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    need = least_overlap(len(a), len(b), percent)
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum()) >= need


def survey(documents: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Rows (kind 0: key, set size, node, signature) per document and (kind 1: slot, count) per task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            sizes, nodes, marks, used = [], [], [], [np.empty(0, np.int64)]
            for t in batch.column(1).to_pylist():
                s = shingle_hashes(t, words)
                used.append((s >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
                sizes.append(len(s))
                nodes.append(digest(s))
                marks.append(signature(s) if len(s) else None)
            slots += np.bincount(np.concatenate(used), minlength=len(slots))
            yield pa.RecordBatch.from_pydict({"kind": np.zeros(len(sizes), np.int32), "key": batch.column(0), "n": pa.array(sizes, pa.int64()), "node": pa.array(nodes, pa.int64()), "mark": pa.array(marks, pa.binary())})
        used = np.flatnonzero(slots)
        yield pa.RecordBatch.from_pydict({"kind": np.ones(len(used), np.int32), "key": pa.array(used, pa.int64()), "n": slots[used], "node": np.zeros(len(used), np.int64), "mark": pa.nulls(len(used), pa.binary())})

    return stored(documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(scan, "kind int, key long, n long, node long, mark binary"), "shingle-sets")


def prefixes(documents: DataFrame, text: str, slots: np.ndarray, words: int, percent: int) -> DataFrame:
    """(shingle, part, node, n, place) for the prefix of each set; a set comes once from a task. part is -1 where a group is whole."""
    mean = max(1.0, float(slots.mean()))
    hot = slots > HOT * mean

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            found: list[np.ndarray] = []
            owners, sizes = [], []
            for t in batch.column(0).to_pylist():
                s = shingle_hashes(t, words)
                node = digest(s)
                if not len(s) or node in seen:
                    continue
                seen.add(node)
                slot = (s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                found.append(s[np.lexsort((s, slots[slot]))[:prefix_length(len(s), percent)]])
                owners.append(node)
                sizes.append(len(s))
            if not found:
                continue
            lengths = np.array([len(f) for f in found])
            shingle = np.concatenate(found)
            node = np.repeat(np.array(owners, np.int64), lengths)
            place = np.arange(len(shingle)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            part = np.where(hot[(shingle >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], node % PARTS, -1)
            yield pa.RecordBatch.from_pydict({"shingle": shingle.view(np.int64), "part": part.astype(np.int32), "node": node,
                                              "n": np.repeat(np.array(sizes, np.int32), lengths), "place": place.astype(np.int32)})

    return documents.select(F.col(text).alias("text")).mapInArrow(scan, "shingle long, part int, node long, n int, place int")


def _allowed(n: np.ndarray, at: np.ndarray, m: np.ndarray, to: np.ndarray, percent: int) -> np.ndarray:
    """Length filter, and positional filter: what stands before and after the shared shingle bounds the overlap."""
    length = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    most = np.minimum(at, to) + 1 + np.minimum(n - 1 - at, m - 1 - to)
    return length & (most >= least_overlap(n, m, percent))


def _with_pivots(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of groups with two nodes or more, with the group's smallest node, and whether the filters let the pair pass.

    The smallest node itself is left out, except in the parts of a split group: those meet again.
    """
    names = ("shingle", "part", "node", "n", "place")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only the pivot of the open group is carried from batch to batch, however large the group is.
        last: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(names)}
            if last is not None:
                rows = {k: np.concatenate([np.array([x], v.dtype), v]) for (k, v), x in zip(rows.items(), last, strict=True)}
            new = np.ones(len(rows["node"]), bool)
            new[1:] = (rows["shingle"][1:] != rows["shingle"][:-1]) | (rows["part"][1:] != rows["part"][:-1])
            starts = np.flatnonzero(new)
            head = np.repeat(starts, np.diff(np.append(starts, len(new))))
            pivot = rows["node"][head]
            other = rows["node"] != pivot
            ok = other & _allowed(rows["n"].astype(np.int64), rows["place"], rows["n"][head].astype(np.int64), rows["place"][head], percent)
            keep = other | (rows["part"] >= 0)
            out = {**rows, "pivot": pivot, "ok": ok, "pivot_n": rows["n"][head], "pivot_place": rows["place"][head]}
            yield pa.RecordBatch.from_pydict({k: v[keep] for k, v in out.items()})
            last = tuple(v[starts[-1]] for v in rows.values())

    return (rows.repartition("shingle", "part").sortWithinPartitions("shingle", "part", "node")
            .mapInArrow(scan, "shingle long, part int, node long, n int, place int, pivot long, ok boolean, pivot_n int, pivot_place int"))


def _open_rows(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (shingle, component, n, ...) that meet another component in their group, in a set that the length filter allows.

    Sets that the length filter allows lie in the same band of lengths or in adjoining ones. A group has few bands.
    """
    # A little wider than the filter, so that rounding cannot part two sets by more than a band.
    width = math.log(100 / percent) * 1.001 + 1e-6
    banded = rows.withColumn("band", F.floor(F.log("n") / width))
    # Dealt by shingle, so that neither sum nor join shuffles again.
    found = banded.repartition("shingle").groupBy("shingle", "band").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    near = found.select("shingle", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), "least", "most")
    mixed = near.groupBy("shingle", "band").agg(F.min("least").alias("least"), F.max("most").alias("most")).where("least < most")
    mixed = mixed.groupBy("shingle").agg(F.collect_list("band").alias("bands"))
    return banded.join(mixed, "shingle").where(F.array_contains("bands", F.col("band"))).drop("band", "bands")


def _next_pivots(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): for each node that the filters let pass with the pivot of one of its groups, the first such pivot b.

    rows: shingle, component, node, n, place. The order of pivots is that of a hash of node and turn, the same in all groups.
    """
    order = F.xxhash64("node", F.lit(turn))
    chosen = rows.groupBy("shingle").agg(F.min(F.struct(order.alias("order"), "node", "component", "n", "place")).alias("p"))
    chosen = chosen.select("shingle", F.col("p.order").alias("order"), *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("node", "component", "n", "place")])
    n, m, at, to = (F.col(c).cast("long") for c in ("n", "p_n", "place", "p_place"))
    most = F.least(at, to) + 1 + F.least(n - 1 - at, m - 1 - to)
    passed = ((F.col("component") != F.col("p_component")) & (100 * F.least(n, m) >= percent * F.greatest(n, m))
              & (most * (100 + percent) >= percent * (n + m)))
    first = rows.join(chosen, "shingle").where(passed).groupBy(F.col("node").alias("a")).agg(F.min(F.struct("order", "p_node")).alias("p"))
    return first.select("a", F.col("p.p_node").alias("b"))


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after further links (a, b) between nodes; parts lists the nodes that had a link before."""
    ends = links.select("a", "b")
    for side in ("a", "b"):
        ends = ends.join(parts.select(F.col("node").alias(side), F.col("component").alias(f"{side}_part")), side, "left")
    ends = stored(ends.select("a", "b", F.coalesce("a_part", "a").alias("u"), F.coalesce("b_part", "b").alias("v")), "component-links")
    joined = connected(ends, "u", "v").select(F.col("node").alias("old"), F.col("component").alias("new"))
    known = parts.join(joined, parts["component"] == joined["old"], "left").select("node", F.coalesce("new", "component").alias("component"))
    # Nodes that get their first link are components of their own before.
    fresh = joined.join(parts.select(F.col("component").alias("old")).distinct(), "old", "left_anti").select(F.col("old").alias("node"), F.col("new").alias("component"))
    return stored(known.union(fresh), "components")


def _first_meeting(n: np.ndarray, at: np.ndarray, m: np.ndarray, to: np.ndarray, percent: int) -> np.ndarray:
    """Length filter, and positional filter for the first shingle that two sets share: nothing before it counts.

    Where it holds for a shared shingle it holds for all shared ones before, so no similar pair is lost at its first.
    """
    length = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    return length & (1 + np.minimum(n - 1 - at, m - 1 - to) >= least_overlap(n, m, percent))


def _met_before(earlier: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows a and b have an earlier shingle in common; earlier: a list per row, filled up with null."""
    short = np.full((len(earlier), EARLIER), 0, np.int64)
    used = np.zeros((len(earlier), EARLIER), bool)
    for i, e in enumerate(earlier):
        short[i, :len(e)] = e
        used[i, :len(e)] = True
    met = np.zeros(len(a), bool)
    for width in (4, EARLIER):
        for start in range(0, len(a), PAIRS >> 6):
            some = start + np.flatnonzero(~met[start:start + (PAIRS >> 6)])
            x, y = a[some], b[some]
            same = (short[x, :width, None] == short[y, None, :width]) & used[x, :width, None] & used[y, None, :width]
            met[some] = same.any(axis=(1, 2))
    return met


def _across(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one shingle whose components differ and which all filters let pass; rows: shingle, component, node, n, place.

    Groups of one component are dropped before the shuffle. A large group is cut into blocks by node, and each pair of blocks
    is a group of its own, so what a task holds has a bound. Near copies share many shingles: a row carries the first EARLIER
    open shingles of its node before its own, and a pair that has met in one of them is not made again.
    """
    spread = (rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("least"), F.max("component").alias("most"))
              .where("least < most").select("shingle", F.ceil(F.col("size") / GROUP).cast("long").alias("blocks")))
    # A node's rows are those of one text, so its list has a bound.
    homes = (rows.join(spread, "shingle").groupBy("node").agg(
        F.first("component").alias("component"), F.first("n").alias("n"), F.array_sort(F.collect_set(F.struct("place", "shingle", "blocks"))).alias("mine"))
        .join(nodes.select("node", "mark"), "node"))
    homes = homes.select("component", "node", "n", "mark", F.col("mine.shingle").alias("shingles"), F.posexplode("mine").alias("nth", "own"))
    homes = homes.select("own.shingle", "component", "node", "n", "own.place", "mark", F.slice("shingles", F.lit(1), F.least("nth", F.lit(EARLIER))).alias("earlier"),
                         "own.blocks", F.pmod(F.xxhash64("node"), F.col("own.blocks")).alias("home"))
    names = ("shingle", "i", "j", "home", "component", "node", "n", "place", "mark", "earlier")
    dealt = homes.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("shingle", F.least("home", "other").alias("i"), F.greatest("home", "other").alias("j"), *names[3:])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, stops in _whole_groups(batches, names, 3):
            component, node, home, place = rows["component"], rows["node"], rows["home"], rows["place"]
            n, crossing, mark = rows["n"].astype(np.int64), rows["i"] != rows["j"], rows["mark"]
            partners = stops - np.arange(len(stops)) - 1
            done = np.concatenate([[0], np.cumsum(partners)])
            begin = 0
            while begin < len(node):
                end = max(begin + 1, int(np.searchsorted(done, done[begin] + PAIRS, "right")) - 1)
                a = np.repeat(np.arange(begin, end), partners[begin:end])
                b = a + 1 + np.arange(len(a)) - (done[a] - done[begin])
                go = (component[a] != component[b]) & ~(crossing[a] & (home[a] == home[b]))
                a, b = a[go], b[go]
                go = _first_meeting(n[a], place[a], n[b], place[b], percent)
                a, b = a[go], b[go]
                if len(a):
                    there, back = np.unique(np.concatenate([a, b]), return_inverse=True)
                    go = ~_met_before(rows["earlier"][there], back[:len(a)], back[len(a):])
                    a, b = a[go], b[go]
                go = np.fromiter((may_be_similar(*x, percent) for x in zip(n[a].tolist(), mark[a], n[b].tolist(), mark[b], strict=True)), bool, len(a))
                a, b = node[a[go]], node[b[go]]
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": np.maximum(a, b), "b": np.minimum(a, b)})
                begin = end

    return dealt.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j").mapInArrow(scan, "a long, b long")


def _whole_groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], key: int) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Sorted rows in runs of whole groups, with the end of each row's group; the first key columns make a group.

    A group that goes over batches is held until it ends; here its size has a bound.
    """
    held: list[dict[str, np.ndarray]] = []

    def ready() -> tuple[dict[str, np.ndarray], np.ndarray]:
        rows = {k: np.concatenate([h[k] for h in held]) for k in names}
        new = np.logical_or.reduce([rows[k][1:] != rows[k][:-1] for k in names[:key]])
        stops = np.append(np.flatnonzero(new) + 1, len(new) + 1)
        return rows, np.repeat(stops, np.diff(np.concatenate([[0], stops])))

    for batch in batches:
        if batch.num_rows:
            held.append({k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(names)})
            rows, stops = ready()
            last = int(np.searchsorted(stops, stops[-1], "left"))
            if last:
                yield {k: v[:last] for k, v in rows.items()}, stops[:last]
            held = [{k: v[last:] for k, v in rows.items()}]
    if held:
        yield ready()


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the suffix filter lets pass; nodes: node, n, mark and others."""
    sides = pairs
    for side in ("a", "b"):
        sides = sides.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("mark").alias(f"{side}_mark")), side)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2, 6)]
            keep = [may_be_similar(n, x, m, y, percent) for n, x, m, y in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return sides.select("a", "b", "a_n", "a_mark", "b_n", "b_mark").mapInArrow(scan, "a long, b long")


def _may_be_among(keys: DataFrame, key: str) -> Callable[[Column | str], Column]:
    """A test that each of the whole numbers or nulls in column key passes; few others do while keys are few against WANTED_BITS.

    Only the bits reach the driver and the tasks.
    """
    def slot(c: Column | str) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast("long") if isinstance(c, str) else c.cast("long")), F.lit(WANTED_BITS))

    size = 1 << 15  # bits in one of Spark's bitmaps, which count from 1
    maps = keys.select((slot(key) + 1).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bits = np.zeros(WANTED_BITS // 8, np.uint8)
    for r in maps.collect():
        bits[(r["bucket"] - 1) * size // 8:r["bucket"] * size // 8] = np.frombuffer(r["bits"], np.uint8)

    @pandas_udf("boolean")
    def test(slots: pd.Series) -> pd.Series:
        s = slots.to_numpy()
        return pd.Series((bits[s >> 3] >> (s & 7).astype(np.uint8) & 1).astype(bool))

    return lambda c: test(slot(c))


def verified(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the similarity; nodes: (node, key of one document that has the set)."""
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(SALTS)).alias("salt"))
    wanted = (salted.select(F.col("a").alias("node"), "b", "salt", F.lit(1).alias("role"))
              .union(salted.select(F.col("b").alias("node"), "b", "salt", F.lit(0).alias("role")).distinct()))
    wanted = stored(wanted.join(nodes.select("node", "low"), "node").select(F.col("low").alias("__key"), "node", "b", "salt", "role"), "wanted-rows")
    texts = documents.select(F.col(key).cast("long").alias("__own"), F.col(text).alias("text")).where(_may_be_among(wanted, "__key")(key))
    dealt = (texts.join(wanted, F.col("__own").eqNullSafe(F.col("__key"))).select("b", "salt", "role", "node", "text")
             .repartition("b", "salt").sortWithinPartitions("b", "salt", "role"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own = None, np.empty(0, np.uint64)
        for batch in batches:
            left, right = [], []
            b, role, node = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for i in range(batch.num_rows):
                if role[i] == 1 and pivot != b[i]:
                    continue
                s = shingle_hashes(batch.column(4)[i].as_py(), words)
                if digest(s) != node[i]:
                    continue
                if role[i] == 0:
                    pivot, own = b[i], s
                elif similar(own, s, percent):
                    left.append(node[i])
                    right.append(pivot)
            if left:
                yield pa.RecordBatch.from_pydict({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return dealt.mapInArrow(scan, "a long, b long").distinct()


def _linked(df: DataFrame, key: str, text: str, nodes: DataFrame, slots: np.ndarray, words: int, percent: int) -> DataFrame:
    """(node, component) of the nodes that have a link."""
    rows = stored(_with_pivots(prefixes(df, text, slots, words, percent), percent), "prefix-rows")
    heads = rows.select("shingle", F.col("pivot").alias("node"), F.col("pivot_n").alias("n"), F.col("pivot_place").alias("place"))
    first = rows.where("ok").groupBy(F.col("node").alias("a")).agg(F.min("pivot").alias("b"))
    first = stored(plausible(first, nodes, percent), "first-pairs")
    links = stored(verified(first, nodes, df, key, text, words, percent), "first-links")
    parts = connected(links, "a", "b")
    every = rows.select("shingle", "node", "n", "place").union(heads.distinct())
    tried = first
    for turn in range(ROUNDS):
        placed = every.join(parts, "node", "left").select("shingle", F.coalesce("component", "node").alias("component"), "node", "n", "place")
        every = stored(_open_rows(placed, percent), "open-rows")
        more = _next_pivots(every, turn, percent).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        more = stored(plausible(more.join(tried, ["a", "b"], "left_anti"), nodes, percent), "round-pairs")
        n_pairs = more.count()
        every = every.drop("component")
        if not n_pairs:
            break
        found = stored(verified(more, nodes, df, key, text, words, percent), "round-links")
        n_links = found.count()
        tried = tried.union(more)
        if n_links:
            parts = _merged(parts, found)
        if n_links < YIELD * n_pairs:
            break
    placed = every.join(parts, "node", "left").select("shingle", F.coalesce("component", "node").alias("component"), "node", "n", "place")
    rest = stored(_across(stored(_open_rows(placed, percent), "open-rows"), nodes, percent).distinct().join(tried, ["a", "b"], "left_anti"), "rest-pairs")
    found = stored(verified(rest, nodes, df, key, text, words, percent), "rest-links")
    return _merged(parts, found)


def jaccard_components(df: DataFrame, key: str, text: str, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of df: key, n_shingles, component_id.

    Words are runs of other than ASCII white space, with A-Z lowered; a set holds the distinct runs of words, or the whole
    sequence where there are fewer. Two documents link when 100 * intersection >= percent * union. component_id is the
    smallest key reachable by links. A null or empty text, or one of white space, has an empty set and no links. A null key
    takes part in links but is no name unless all keys of a component are null. Repeated rows are rows of their own; an
    empty table gives no rows. Other columns are not carried. key must be a whole number.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    small_batches(df.sparkSession)
    both = survey(df, key, text, words)
    sets = both.where("kind = 0").select("key", "n", "node")
    slots = np.zeros(1 << SLOT_BITS, np.int64)
    for r in both.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).collect():
        slots[r["key"]] = r["n"]
    nodes = stored(both.where("kind = 0 AND n > 0").groupBy("node").agg(F.min("key").alias("low"), F.max("n").alias("n"), F.max("mark").alias("mark")), "shingle-nodes")
    parts = stored_alone(lambda: _linked(df, key, text, nodes, slots, words, percent), "components")
    named = nodes.select("node", "low").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.join(named.groupBy("component").agg(F.min("low").alias("component_id")), "component").select("node", "component_id")
    with_set = sets.where("n > 0").join(named, "node").select("key", "n", "component_id")
    empty = sets.where("n = 0").select("key", "n", F.col("key").alias("component_id"))
    return with_set.union(empty).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")
