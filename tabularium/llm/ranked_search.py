"""Ranked lexical search without random access (NRA): impact-sorted lists read in step, score intervals per document.

Documents are cut into terms once; only postings of terms that an item may hold are written. They are dealt to blocks of
documents by a hash, and every block meets every block of items in one task. There each term's list is sorted by impact, and
an item's lists are read from the top to the same, doubling, depth. What has been read of a document is its lower bound; the
upper adds the last impact read of every list where it has not been seen and still may be. Reading goes on until no document
that can reach the best has an open interval, so membership, order, ties and scores are final. The best of the blocks
are then ranked together.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tabularium.session import stored

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Bytes of a text cut into terms at a time; terms are first told by so many bits of their CRC; postings in a block of
#: documents, terms in a block of items, entries read of each list at first, and cells of (term, document) held at a time.
SLICE, BITS, POSTINGS, ITEM_TERMS, DEPTH, CELLS = 1 << 20, 22, 100_000, 50_000, 64, 1 << 24


def count_terms(raw: bytes) -> Counter:
    """How often each term occurs; only A-Z are lowered. A long text is cut at breaks between terms."""
    if len(raw) <= SLICE:
        return Counter(_TERM.findall(raw.lower()))
    found, at = Counter(), 0
    while at < len(raw):
        stop = _BREAK.search(raw, at + SLICE) if at + SLICE < len(raw) else None
        end = stop.start() if stop else len(raw)
        found.update(_TERM.findall(raw[at:end].lower()))
        at = end
    return found


def _texts(column: pa.Array) -> Iterator[Counter]:
    for raw in column.cast(pa.binary()).to_pylist():
        yield count_terms(raw or b"")


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term, times) of the items; rows of one id are one item."""
    rows = items.select(F.col(key).alias("item"), F.col(text).cast("binary").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))),
                 pa.array([t for f in found for t in f], pa.binary()), pa.array([n for f in found for n in f.values()], pa.int64())], ["item", "term", "times"])

    shape = StructType([StructField("item", rows.schema["item"].dataType)]).add("term", "binary").add("times", "long")
    return rows.mapInArrow(cut, shape).groupBy("item", "term").agg(F.sum("times").alias("times"))


def _marks(terms: DataFrame) -> bytes:
    """A bitmap of the CRCs of the terms; 2 ** (BITS - 3) bytes reach the driver whatever the number of terms."""
    place = F.crc32("term").bitwiseAND((1 << BITS) - 1) + 1
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    parts = terms.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    for row in parts.collect():
        start = (row["part"] - 1) * 4096
        bits[start:start + 4096] |= np.frombuffer(row["bits"], np.uint8)[:len(bits) - start]
    return bits.tobytes()


def _postings(documents: DataFrame, marks: bytes) -> DataFrame:
    """(key, id, term, tf, n) for the marked terms of each document, and rows without a term that count documents (tf) and their terms (n)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(marks, np.uint8), bitorder="little").tobytes()
        mask = (1 << BITS) - 1
        for batch in batches:
            rows, words, times, lengths = [], [], [], []
            with_terms = 0
            for i, found in enumerate(_texts(batch.column(2))):
                n = found.total()
                with_terms += n > 0
                kept = [t for t in found if wanted[zlib.crc32(t) & mask]]
                rows += [i] * len(kept)
                words += kept
                times += [found[t] for t in kept]
                lengths.append(n)
            taken = pa.array(np.array(rows, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(words, pa.binary()), pa.array(times, pa.int64()),
                 pa.array(np.array(lengths, np.int64)[rows] if rows else [], pa.int64())], ["key", "id", "term", "tf", "n"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, batch.column(1).type), pa.nulls(1, pa.binary()),
                                              pa.array([with_terms], pa.int64()), pa.array([sum(lengths)], pa.int64())], ["key", "id", "term", "tf", "n"])

    shape = StructType([StructField("key", LongType()), StructField("id", documents.schema["id"].dataType)]).add("term", "binary").add("tf", "long").add("n", "long")
    return documents.select(F.monotonically_increasing_id().alias("key"), "id", F.col("text").cast("binary")).mapInArrow(cut, shape)


def search_lists(lists: list[tuple[np.ndarray, np.ndarray]], floors: list[np.ndarray], size: int, best: int, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents (numbers below size) of the best scores and those scores, by NRA.

    lists: for each term, documents and their impacts, highest first. floors: for each term, the least impact that it can have
    in each document. tie orders documents of equal scores. Scores of 0 do not count.
    """
    lower = np.zeros(size, np.int64)
    seen = np.zeros((len(lists), size), bool)
    depth, before = DEPTH, 0
    while True:
        more = np.zeros(size, np.int64)
        for i, (documents, impacts) in enumerate(lists):
            read = documents[before:depth]
            lower[read] += impacts[before:depth]
            seen[i, read] = True
            if depth < len(impacts):
                last = impacts[depth - 1]
                more += np.where(seen[i] | (floors[i] > last), 0, last)
        upper = lower + more
        reached = np.partition(lower, size - best)[size - best] if size > best else 0
        rivals = np.flatnonzero((upper >= reached) & (upper > 0))
        if not more[rivals].any():
            break
        depth, before = 2 * depth, depth
    order = rivals[np.lexsort((tie[rivals], -lower[rivals]))][:best]
    return order, lower[order]


def _search_block(best: int):
    """The search of a block of documents for a block of items."""

    def search(_: tuple, postings: pa.Table, items: pa.Table) -> pa.Table:
        rows: dict = {}
        for place, (item, term, weight) in enumerate(zip(items["item"].to_pylist(), items["term"].to_pylist(), items["weight"].to_pylist(), strict=True)):
            rows.setdefault(item, (place, []))[1].append((term, weight))
        keys, number = np.unique(postings["key"].to_numpy(), return_inverse=True)
        first = np.zeros(len(keys), np.int64)
        first[number] = np.arange(len(number))
        tf, m = postings["tf"].to_numpy(), postings["m"].to_numpy()
        share = (1_000_000_000 * tf) // (1000 * tf + 8 * m)
        words = postings["term"].combine_chunks().dictionary_encode()
        code = words.indices.to_numpy()
        order = np.lexsort((number, -share, code))
        starts = np.searchsorted(code[order], np.arange(len(words.dictionary) + 1))
        place_of = {t: i for i, t in enumerate(words.dictionary.to_pylist())}
        least = np.zeros(len(keys), np.int64)
        least[number] = 1_000_000_000 // (1000 + 8 * m)
        ids = postings["id"].take(pa.array(first)).to_pylist()
        tie = np.empty(len(keys), np.int64)
        tie[sorted(range(len(keys)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i], keys[i]))] = np.arange(len(keys))
        out: list[list] = [[], [], []]
        for place, terms in rows.values():
            held = [(place_of[t], w) for t, w in terms if t in place_of and w > 0]
            if not held:
                continue
            width = max(best, CELLS // len(held))
            found: list[tuple] = []
            for start in range(0, len(keys), width):
                size = min(width, len(keys) - start)
                lists, floors = [], []
                for i, w in held:
                    at = order[starts[i]:starts[i + 1]]
                    if size < len(keys):
                        at = at[(number[at] >= start) & (number[at] < start + size)]
                    lists.append((number[at] - start, w * share[at]))
                    floors.append(w * least[start:start + size])
                documents, scores = search_lists(lists, floors, size, best, tie[start:start + size])
                found += zip((-scores).tolist(), tie[start + documents].tolist(), (start + documents).tolist(), strict=True)
            for score, _, document in sorted(found)[:best]:
                out[0].append(place)
                out[1].append(int(first[document]))
                out[2].append(-score)
        return pa.Table.from_arrays([items["item"].take(pa.array(out[0], pa.int64())), postings["key"].take(pa.array(out[1], pa.int64())),
                                     postings["id"].take(pa.array(out[1], pa.int64())), pa.array(out[2], pa.int64())], names=["item", "key", "id", "score"])

    return search


def search(items: DataFrame, item_key: str, item_text: str, documents: DataFrame, key: str, text: str, best: int = 10) -> DataFrame:
    """For each item its best documents: item_key, rank (from 1), key, score.

    Terms are runs of digits, letters and characters beyond ASCII of the whole text. With N documents of at least one term, L
    terms in them, n in a document, m = 100 - 75 + (75 * n * N) div L, a term of w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))
    that occurs tf times adds w * ((1000000000 * tf) div (1000 * tf + 8 * m)) for each time that the item holds it. Scores of 0 do
    not count; equal scores are ranked by key, null keys last.

    Null or empty texts have no terms and are in no result; repeated documents are ranked each by itself; items of one id, null
    included, are one item; empty tables give no rows; other columns are not carried, and clash with nothing. A text is cut into
    terms in slices; a task holds a block of postings and of items, and N and L are all that the driver gets besides a bitmap
    of fixed size. 64-bit overflow of 75 * n * N fails the job.
    """
    asked = stored(item_terms(items, item_key, item_text), "item-terms")
    found = stored(_postings(documents.select(F.col(key).alias("id"), F.col(text).alias("text")), _marks(asked)), "postings")
    total = found.agg(F.sum(F.when(F.col("term").isNull(), F.col("tf"))), F.sum(F.when(F.col("term").isNull(), F.col("n"))), F.count("term")).first()
    n_documents, n_terms, n_postings = (x or 0 for x in total)
    kinds = StructType([StructField("item", asked.schema["item"].dataType), StructField("key", LongType()),
                        StructField("id", found.schema["id"].dataType), StructField("score", LongType())])
    out = [F.col("item").alias(item_key), F.col("rank").cast(IntegerType()).alias("rank"), F.col("id").alias(key), "score"]
    if not n_postings:
        return items.sparkSession.createDataFrame([], kinds.add("rank", IntegerType())).select(*out)
    blocks, parts = -(-n_postings // POSTINGS), -(-asked.count() // ITEM_TERMS)
    rarity = found.where("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000) * F.log((F.lit(2 * n_documents) + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")
    wanted = asked.join(rarity, "term").select("item", "term", (weight * F.col("times")).alias("weight"),
                                               F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int").alias("part"))
    wanted = wanted.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    dealt = found.where("term IS NOT NULL").select(
        "key", "id", "term", "tf", F.expr(f"25 + (75 * n * {n_documents}L) div {n_terms}L").alias("m"),
        F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    local = dealt.groupBy("block", "part").cogroup(wanted.groupBy("block", "part")).applyInArrow(_search_block(best), kinds)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "key"))
    return local.withColumn("rank", place).where(F.col("rank") <= best).select(*out)
