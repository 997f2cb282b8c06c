"""Removal of repeated passages by the common-prefix interval tree of a sampled suffix array.

Every window of L bytes is represented by an anchor, the least hashed run of K bytes in it. Equal windows have equal anchors
at equal places, so only suffixes at anchors need sorting, in both directions: K = 128 of L = 400 leaves about one position
in 137.

1. A scan emits the anchors with the hash of the K bytes and that of the context (all bytes that windows over the anchor can
   reach). An anchor whose context occurs again is covered as far as its context goes; equal contexts are one leaf from here.
2. Anchors that share the K bytes but not the context are leaves of two sorted arrays, of what follows and of what precedes.
   A stack scan of the common prefix lengths of neighbours visits the interval tree; the stack at a leaf holds the depths of
   the intervals that contain it. All leaves of a K-gram meet in one task, unless there are more than LEAVES of them: the
   arrays of such K-grams are range-partitioned, and what a partition needs of its neighbours is the stack at their border,
   at most L numbers.
3. An interval of depth d to the right is a repeat of L bytes for those of its leaves that agree on L - d bytes to the left
   (and the mirror of it). That is the test of left extensions: leaves of one interval are grouped by the bytes before them,
   and groups with two occurrences or more are repeats, with all of their occurrences. Leftmost and rightmost such window
   of an anchor bound what it covers, as all of its windows overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from tabularium.llm.batches import small_batches
from tabularium.llm.hashing import window_hashes
from tabularium.llm.names import free_names, without
from tabularium.session import cut_lineage, stored, stored_alone

#: Bytes hashed at once; longer texts go in overlapping pieces, so memory does not grow with the text.
PIECE = 1 << 20
#: Leaves of a seed that a task takes at most (about a kilobyte each), and leaves in a partition of the arrays of larger seeds.
LEAVES, PART_LEAVES = 50_000, 10_000


def _seed_bits(length: int) -> int:
    """log2 of the anchor run: the largest power of two up to a third of the window, 128 bytes at most."""
    return max(0, min(7, (length // 3).bit_length() - 1))


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all windows: of the runs in a window the least hash, all of them on a tie."""
    bits = _seed_bits(length)
    run, width = 1 << bits, length - (1 << bits) + 1
    places, hashes = [], []
    for start in range(0, max(1, len(data) - length + 1), PIECE):
        raw = np.frombuffer(data[start:start + PIECE + length - 1], np.uint8)
        if len(raw) < length:
            break
        h = window_hashes(raw, bits)
        at = _window_minima(h, width)
        places.append(at + start)
        hashes.append(h[at])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first].view(np.int64)


def _running(x: np.ndarray, width: int, pick: np.ufunc, filler: int) -> np.ndarray:
    """The least or greatest of every width neighbours, from running ones of blocks in both directions."""
    padded = np.full(-(-len(x) // width) * width, filler, np.uint64)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    back = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:len(x) - width + 1], ahead[width - 1:len(x)])


def _window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least value of some window; equal ones all count."""
    least = _running(h, width, np.minimum, np.iinfo(np.uint64).max)
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_running(np.concatenate([edge, least, edge]), width, np.maximum, 0) == h)


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def scan_anchors(rows: DataFrame, length: int) -> DataFrame:
    """(seed, context, key, version, place) of every anchor; rows: key, version, text."""
    reach = length - (1 << _seed_bits(length))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, contexts, which = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                data = (text or "").encode("utf-8", "replace")
                if len(data) < length:
                    continue
                place, seed = anchors(data, length)
                parts.append((place, seed))
                which.append(np.full(len(place), i))
                for p in place.tolist():
                    before = min(p, reach)
                    contexts.append(_digest(b"%d " % before + data[p - before:p + length]))
            if parts:
                row = pa.array(np.concatenate(which))
                yield pa.RecordBatch.from_pydict({
                    "seed": np.concatenate([s for _, s in parts]), "context": np.array(contexts, np.int64),
                    "key": batch.column(0).take(row), "version": batch.column(1).take(row),
                    "place": np.concatenate([p for p, _ in parts]).astype(np.int32)})

    return rows.mapInArrow(scan, f"seed long, context long, key {dict(rows.dtypes)['key']}, version long, place int")


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


def _neighbours(seeds: list[int], strings: list[bytes], width: int) -> list[int]:
    """Common prefix lengths of neighbours in a sorted array; -1 between different seeds. The first entry is -1."""
    out = [-1]
    for start in range(0, len(strings) - 1, 4096):
        some = strings[start:start + 4097]
        lengths = np.array([len(s) for s in some])
        grid = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in some), np.uint8).reshape(len(some), width)
        differ = grid[1:] != grid[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        out += np.minimum(first, np.minimum(lengths[1:], lengths[:-1])).tolist()
    return [-1 if i == 0 or seeds[i] != seeds[i - 1] else c for i, c in enumerate(out)]


def depths_on_the_left(common: list[int], begin: list[int]) -> Iterator[list[int]]:
    """For each leaf, the depths of its intervals with a leaf on the left: the stack of a scan, strictly rising.

    common[i] is the common prefix with the leaf before; -1 empties the stack. begin is the stack at the first leaf.
    """
    stack = list(begin)
    for i, c in enumerate(common):
        if i or c >= 0:
            if c < 0:
                stack = []
            else:
                while stack and stack[-1] > c:
                    stack.pop()
                if not stack or stack[-1] < c:
                    stack.append(c)
        yield stack


def _cap(stack: list[int], c: int) -> list[int]:
    """The stack one leaf further, over a border with common prefix c."""
    return sorted({*(d for d in stack if d < c), c}) if c >= 0 else []


def _depths(array: DataFrame, width: int) -> DataFrame:
    """Leaves of a sorted, range-partitioned array with the depths of their intervals.

    array: seed, string, part (its number) and others; the result has those columns and depths. A first pass takes from each partition its
    border leaves and stacks; the second starts its scans with what lies beyond the border.
    """
    names = array.columns

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, strings, part = _leaves(batches)
        if seeds:
            common = _neighbours(seeds, strings, width)
            left: list[int] = []
            for left in depths_on_the_left(common, []):  # noqa: B007
                pass
            right: list[int] = []
            for right in depths_on_the_left([-1, *common[:0:-1]], []):  # noqa: B007
                pass
            inner = min(common[1:], default=width)
            yield pa.RecordBatch.from_pylist([{
                "part": part, "seed_a": seeds[0], "first": strings[0], "seed_z": seeds[-1], "last": strings[-1],
                "whole": inner if seeds[0] == seeds[-1] else -1, "left": list(left), "right": list(right)}], BORDER)

    found = sorted(array.select("seed", "string", "part").mapInArrow(borders, BORDER_DDL).collect(), key=lambda r: r["part"])
    begin, end = {}, {}
    for order, mine, theirs, out, edge in ((found, "left", ("seed_z", "last"), begin, ("seed_a", "first")),
                                           (found[::-1], "right", ("seed_a", "first"), end, ("seed_z", "last"))):
        carried: list[int] = []
        previous = None
        for r in order:
            if previous is not None and previous[theirs[0]] == r[edge[0]]:
                carried = _cap(carried, _common(previous[theirs[1]], r[edge[1]]))
            else:
                carried = []
            out[r["part"]] = carried
            through = [d for d in carried if d < r["whole"]] + ([r["whole"]] if any(d >= r["whole"] for d in carried) else []) if r["whole"] >= 0 else []
            carried = sorted({*r[mine], *through})
            previous = r

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        seeds, strings = table.column("seed").to_pylist(), table.column("string").to_pylist()
        part = table.column("part")[0].as_py()
        common = _neighbours(seeds, strings, width)
        left = [list(s) for s in depths_on_the_left(common, begin.get(part, []))]
        right = [list(s) for s in depths_on_the_left([-1, *common[:0:-1]], end.get(part, []))][::-1]
        both = [sorted({*a, *b}) for a, b in zip(left, right, strict=True)]
        table = table.append_column("depths", pa.array(both, pa.list_(pa.int32())))
        yield from table.combine_chunks().to_batches(10_000)

    types = dict(array.dtypes)
    return array.mapInArrow(scan, ", ".join(f"`{n}` {types[n]}" for n in names) + ", depths array<int>")


BORDER_DDL = "part int, seed_a long, first binary, seed_z long, last binary, whole int, left array<int>, right array<int>"
BORDER = pa.schema([("part", pa.int32()), ("seed_a", pa.int64()), ("first", pa.binary()), ("seed_z", pa.int64()), ("last", pa.binary()),
                    ("whole", pa.int32()), ("left", pa.list_(pa.int32())), ("right", pa.list_(pa.int32()))])


def _leaves(batches: Iterator[pa.RecordBatch]) -> tuple[list[int], list[bytes], int]:
    seeds, strings, part = [], [], 0
    for batch in batches:
        seeds += batch.column(0).to_pylist()
        strings += batch.column(1).to_pylist()
        part = batch.column(2)[0].as_py() if batch.num_rows else part
    return seeds, strings, part


def _sorted_by(seeds: list[int], strings: list[bytes], width: int) -> tuple[list[int], list[int], np.ndarray]:
    """The order of the leaves in a sorted array, the common prefixes of neighbours there, and the longest of each leaf."""
    order = sorted(range(len(seeds)), key=lambda i: (seeds[i], strings[i]))
    common = _neighbours([seeds[i] for i in order], [strings[i] for i in order], width)
    longest = np.empty(len(seeds), np.int64)
    longest[order] = np.maximum(common, [*common[1:], -1])
    return order, common, longest


def _depths_from(order: list[int], common: list[int], least: np.ndarray) -> Iterator[tuple[int, int]]:
    """(leaf, depth) for the intervals of each leaf that are at least so deep."""
    for some, along in ((order, common), (order[::-1], [-1, *common[:0:-1]])):
        for i, stack in zip(some, depths_on_the_left(along, []), strict=True):
            for d in reversed(stack):
                if d < least[i]:
                    break
                yield i, d


def _spans_of_seeds(rows: list[tuple], length: int) -> list[tuple]:
    """(key, version, start, stop) that the repeats of whole seeds cover; rows: seed, key, version, place, copies, before, after.

    A leaf agrees with no other on more bytes ahead, or back, than with its neighbour in that array; only intervals that
    reach length together with that are looked at.
    """
    rows = list({r[:4]: r for r in rows}.values())
    seeds = [r[0] for r in rows]
    ahead, common_ahead, far = _sorted_by(seeds, [r[6] for r in rows], length)
    back, common_back, near = _sorted_by(seeds, [r[5] for r in rows], length - (1 << _seed_bits(length)))
    shifts: dict[int, set[int]] = {}
    for i, d in _depths_from(ahead, common_ahead, np.where(near >= 0, length - near, length + 1)):
        shifts.setdefault(i, set()).add(length - d)
    for i, d in _depths_from(back, common_back, np.where(far >= 0, length - far, length + 1)):
        shifts.setdefault(i, set()).add(d)
    found: dict[tuple, int] = {}
    mine: dict[int, list[tuple]] = {}
    for i, some in shifts.items():
        seed, _, _, _, copies, before, after = rows[i]
        mine[i] = [(seed, s, hashlib.blake2b(before[:s][::-1] + after[:length - s], digest_size=16).digest())
                   for s in some if s <= len(before) and length - s <= len(after)]
        for w in mine[i]:
            found[w] = found.get(w, 0) + copies
    out = []
    for i, windows in mine.items():
        _, key, version, place, copies, _, _ = rows[i]
        shared = [w[1] for w in windows if found[w] > 1] if copies == 1 else []
        if shared:
            out.append((key, version, place - max(shared), place - min(shared) + length))
    return out


def seed_spans(leaves: DataFrame, length: int) -> DataFrame:
    """(key, version, start, stop) of the repeats of seeds with few leaves; each seed is dealt with in one task."""
    kind = dict(leaves.dtypes)["key"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        schema = None

        def spans(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*_spans_of_seeds(rows, length), strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(columns[0], schema.field(1).type), pa.array(columns[1], pa.int64()),
                                               pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())], ["key", "version", "start", "stop"])

        for batch in batches:
            schema = batch.schema
            held += zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True)
            if len(held) > PART_LEAVES:
                cut = next((i for i in range(len(held) - 1, -1, -1) if held[i][0] != held[-1][0]), -1) + 1
                if cut:
                    yield spans(held[:cut])
                    held = held[cut:]
        if held:
            yield spans(held)

    dealt = leaves.select("seed", "key", "version", "place", "copies", "before", "after").repartition("seed").sortWithinPartitions("seed")
    return dealt.mapInArrow(scan, f"key {kind}, version long, start int, stop int")


def repeat_groups(leaves: DataFrame, length: int) -> DataFrame:
    """(shift, repeat, seed, key, version, place, copies): the repeats of length bytes that begin shift before an anchor.

    leaves: seed, key, version, place, copies, before (reversed), after. Rows with the same seed, shift and repeat are the
    occurrences of one string; a leaf that stands for several equal contexts counts as so many.
    """
    n = leaves.count()
    if not n:
        return leaves.select(F.lit(0).alias("shift"), F.lit(b"").alias("repeat"), "seed", "key", "version", "place", "copies")
    parts = max(1, -(-n // PART_LEAVES))
    out = None
    for side, width in (("after", length), ("before", length - (1 << _seed_bits(length)))):
        other = "before" if side == "after" else "after"
        array = leaves.select("seed", F.col(side).alias("string"), F.col(other).alias("other"), "key", "version", "place", "copies")
        array = cut_lineage(array.repartitionByRange(parts, "seed", "string", "key", "place").sortWithinPartitions("seed", "string").withColumn("part", F.spark_partition_id()))
        mine = _depths(array, width)
        out = _windows(mine, side == "after", length) if out is None else out.union(_windows(mine, side == "after", length))
    windows = stored(out.distinct(), "repeat-windows")
    keys = ["seed", "shift", "repeat"]
    shared = windows.groupBy(*keys).agg(F.sum("copies").alias("n")).where("n > 1").select(*keys)
    return windows.join(shared, keys, "left_semi")


def _windows(leaves: DataFrame, forward: bool, length: int) -> DataFrame:
    """For each leaf and depth, the window that the interval and the other side make up."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, shift, repeat = [], [], []
            strings, others, depths = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("string", "other", "depths"))
            for i, (string, other, mine) in enumerate(zip(strings, others, depths, strict=True)):
                after, before = (string, other) if forward else (other, string)
                for d in mine:
                    s = length - d if forward else d
                    if s <= len(before) and length - s <= len(after):
                        row.append(i)
                        shift.append(s)
                        repeat.append(hashlib.blake2b(before[:s][::-1] + after[:length - s], digest_size=16).digest())
            taken = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "shift": pa.array(shift, pa.int32()), "repeat": pa.array(repeat, pa.binary()),
                **{c: batch.column(batch.schema.get_field_index(c)).take(taken) for c in ("seed", "key", "version", "place", "copies")}})

    kind = dict(leaves.dtypes)["key"]
    return leaves.mapInArrow(scan, f"shift int, repeat binary, seed long, key {kind}, version long, place int, copies long")


def _repeated_anchors(rows: DataFrame, length: int) -> DataFrame:
    """The anchors whose seed occurs again, and whether its contexts differ (mixed)."""
    found = stored(scan_anchors(rows, length), "anchors")
    seeds = (found.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
             .where("n > 1").select("seed", (F.col("low") != F.col("high")).alias("mixed")))
    return found.join(seeds, "seed")


def repeated_spans(df: DataFrame, key: str, text: str, length: int = 400) -> DataFrame:
    """(key, version, spans): per distinct row with a repeat, the byte spans to remove, some overlapping.

    version is xxhash64 of the text, so that rows with one key and different texts stay apart.
    """
    if length < 8:
        raise ValueError("length must be at least 8")
    reach = length - (1 << _seed_bits(length))
    rows = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    found = stored_alone(lambda: _repeated_anchors(rows, length), "repeated-anchors")
    span = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("stop"))
    place = F.col("place")
    whole = ["key", "version", span(F.greatest(place - reach, F.lit(0)), place + length).alias("span")]
    mixed = found.where("mixed")
    leaves = stored(mixed.groupBy("seed", "context").agg(
        F.count(F.lit(1)).alias("copies"), F.first("key").alias("key"), F.first("version").alias("version"), F.first("place").alias("place")), "anchor-leaves")
    again = leaves.where("copies > 1").select("seed", "context")
    covered = found.where("NOT mixed").select(*whole).union(mixed.join(again, ["seed", "context"], "left_semi").select(*whole))
    sizes = stored(leaves.groupBy("seed").agg(F.count(F.lit(1)).alias("n")), "seeds")
    large = sizes.where(F.col("n") > LEAVES).limit(1).count() > 0
    some = leaves.join(sizes, "seed").groupBy("key", "version").agg(
        F.collect_list(F.struct("seed", "place", "copies", (F.col("n") > LEAVES).alias("large"))).alias("some"))
    same = lambda a: (F.col("key").eqNullSafe(F.col(f"{a}_key"))) & (F.col("version") == F.col(f"{a}_version"))
    texts = rows.join(some.select(F.col("key").alias("m_key"), F.col("version").alias("m_version"), "some"), same("m"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, seed, at, copies, large_, before, after = [], [], [], [], [], [], []
            for i, (text_, some) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                data = (text_ or "").encode("utf-8", "replace")
                for x in some:
                    p = x["place"]
                    row.append(i)
                    seed.append(x["seed"])
                    at.append(p)
                    copies.append(x["copies"])
                    large_.append(x["large"])
                    before.append(data[max(0, p - reach):p][::-1])
                    after.append(data[p:p + length])
            taken = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "seed": pa.array(seed, pa.int64()), "key": batch.column(0).take(taken), "version": batch.column(1).take(taken), "place": pa.array(at, pa.int32()),
                "copies": pa.array(copies, pa.int64()), "large": pa.array(large_, pa.bool_()), "before": pa.array(before, pa.binary()), "after": pa.array(after, pa.binary())})

    kind = dict(rows.dtypes)["key"]
    strings = texts.select("key", "version", "text", "some").mapInArrow(
        cut, f"seed long, key {kind}, version long, place int, copies long, large boolean, before binary, after binary")
    if large:
        strings = stored(strings, "anchor-strings")
    edges = seed_spans(strings.where("NOT large"), length).select("key", "version", F.struct("start", "stop").alias("span"))
    if large:
        groups = repeat_groups(strings.where("large").drop("large"), length)
        most = groups.where("copies = 1").groupBy("key", "version", "place").agg(F.max("shift").alias("most"), F.min("shift").alias("least"))
        edges = edges.union(most.select("key", "version", span(place - F.col("most"), place - F.col("least") + length).alias("span")))
    return covered.union(edges).groupBy("key", "version").agg(F.collect_set("span").alias("spans"))


def merge_spans(spans: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """Ordered maximal runs of overlapping or adjoining spans, within the text."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], min(s["stop"], size)) for s in spans) if spans is not None else []:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _whole(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs drawn in to the borders of characters."""
    out = []
    for a, b in runs:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def remove_repeats(df: DataFrame, key: str, text: str, length: int = 400, whole_characters: bool = False) -> DataFrame:
    """df with kept (the bytes that stay), n_bytes, n_removed and removed (the byte spans cut out).

    A byte goes if a string of length bytes that covers it starts anywhere else as well, in the same text or another; all
    strings are judged on the input. Text counts as UTF-8; null counts as empty and stays so. A text shorter than length has
    no repeat. Repeated rows repeat each other. Keys may be null or shared. Columns of these names are replaced.
    With whole_characters, a character that a cut would split stays whole, so kept is text again.
    """
    small_batches(df.sparkSession)
    names = ("kept", "n_bytes", "n_removed", "removed")
    rest = df.select(*without(df, set(names) - {key, text}))
    own, version, found, done = free_names(rest, "_key", "_version", "_spans", "_cut")
    spans = stored_alone(lambda: repeated_spans(df, key, text, length), "repeat-spans").select(F.col("key").alias(own), F.col("version").alias(version), F.col("spans").alias(found))
    joined = rest.join(spans, F.col(key).eqNullSafe(F.col(own)) & (F.xxhash64(text) == F.col(version)), "left")

    @pandas_udf("kept binary, n_bytes long, n_removed long, removed array<struct<start:int,stop:int>>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lists in batches:
            rows = []
            for t, s in zip(texts, lists, strict=True):
                data = (t or "").encode("utf-8", "replace")
                runs = merge_spans(s, len(data))
                runs = _whole(data, runs) if whole_characters else runs
                keep, at = [], 0
                for a, b in runs:
                    keep.append(data[at:a])
                    at = b
                keep.append(data[at:])
                rows.append((b"".join(keep), len(data), sum(b - a for a, b in runs), runs))
            yield pd.DataFrame(rows, columns=list(names))

    cut_rows = joined.select(*rest.columns, cut(F.col(text), F.col(found)).alias(done))
    return cut_rows.select(*[c for c in rest.columns if c.lower() not in names], f"{done}.*")
