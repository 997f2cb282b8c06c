"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text is a bag of hashed terms: its words, runs of two to four character classes (case, digits and symbols as they are
strung together), and words that repeat the word before. Terms weigh by frequency in the text and rarity in the corpus, and
a truncated singular value decomposition of a bounded sample of labelled texts, by randomised subspace iteration in numpy,
turns them into short latent vectors. Each text is compared with all labelled vectors in blocks, by exact cosine; its most
similar neighbours vote, weighted by a power of their similarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.hashing import mix, word_hashes

BUCKET_BITS, DIMENSIONS, ORDERS = 14, 32, (2, 3, 4)
BUCKETS = 1 << BUCKET_BITS
#: Labelled documents to learn from (in expectation), neighbours that vote, the power of their cosine, texts compared at a
#: time, and the score from which a text is predicted good.
SAMPLE, NEIGHBOURS, POWER, BLOCK, GOOD = 4000, 50, 8, 256, 0.7
_PASSES, _OVERSAMPLE = 3, 8
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48
_CLASS[[0x09, 0x0B, 0x0C, 0x0D]] = 32


def terms(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the terms of a text in UTF-8, ascending, and how often each occurs; no byte has no term."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    words = word_hashes(data)
    again = words[1:][words[1:] == words[:-1]]
    kinds = _CLASS[data]
    keep = np.ones(len(kinds), bool)
    keep[2:] = (kinds[2:] != kinds[1:-1]) | (kinds[1:-1] != kinds[:-2])  # longer runs of a class count as two
    kinds = np.concatenate([[10], kinds[keep], [10]]).astype(np.uint64)
    parts = [words, np.full(len(again), mix(np.array([1], np.uint64))[0])]
    for order in ORDERS:
        h = np.full(max(0, len(kinds) - order + 1), np.uint64(order))
        for i in range(order):
            h = (h ^ kinds[i:len(h) + i]) * np.uint64(0x9E3779B97F4A7C15)
        parts.append(mix(h))
    return np.unique((np.concatenate(parts) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), return_counts=True)


def _bags(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for text in column.cast(pa.binary()).to_pylist():
        yield terms(np.frombuffer(text or b"", np.uint8))


@dataclass
class QualityModel:
    """Rarity of each bucket, axes of the latent space, unit vectors of the labelled texts and their labels.

    Its size depends on BUCKETS, DIMENSIONS and SAMPLE alone, so it may travel with the tasks.
    """

    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def project(self, bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The unit vector of a bag; zero if it has no weight."""
        buckets, counts = bag
        v = ((1 + np.log(counts)) * self.rarity[buckets]) @ self.axes[buckets]
        return _unit(v[None])[0]

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """Mean label of the nearest labelled vectors, weighted by a power of the cosine; those as near as the last count as well.

        Vectors to which no labelled one is similar get the prior.
        """
        out = np.full(len(vectors), self.prior)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(vectors), BLOCK):
            cosine = np.round(vectors[at:at + BLOCK] @ self.vectors.T, 9)  # ties must not hang on the order of sums
            last = np.partition(cosine, -k, axis=1)[:, -k, None]
            weight = np.where(cosine >= last, np.maximum(cosine, 0) ** POWER, 0)
            total = weight.sum(axis=1)
            some = total > 0
            out[at:at + BLOCK][some] = np.clip((weight @ self.labels)[some] / total[some], 0, 1)
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 1e-12)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[float], rarity: np.ndarray, seed: int = 7) -> QualityModel:
    """Latent axes by randomised subspace iteration over the sparse term weights, and the labelled vectors in them."""
    rows = [(b, ((1 + np.log(n)) * rarity[b])) for b, n in bags]
    rows = [(b, w / max(1e-12, np.linalg.norm(w))) for b, w in rows]
    width = min(DIMENSIONS + _OVERSAMPLE, max(1, len(rows)))
    space = np.random.default_rng(seed).normal(size=(BUCKETS, width))
    seen = np.zeros((len(rows), width))
    for turn in range(_PASSES + 1):
        for i, (b, w) in enumerate(rows):
            seen[i] = w @ space[b]
        if turn < _PASSES:
            space[:] = 0
            for i, (b, w) in enumerate(rows):
                space[b] += np.outer(w, seen[i])
            space, _ = np.linalg.qr(space)
    _, _, turned = np.linalg.svd(seen, full_matrices=False)
    axes = (space @ turned.T)[:, :DIMENSIONS]
    model = QualityModel(rarity, axes, np.zeros((0, axes.shape[1])), np.array(labels, np.float64))
    if bags:
        model.vectors = np.array([model.project(bag) for bag in bags])
    return model


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def term_rarity(texts: DataFrame, text: str) -> np.ndarray:
    """log((1 + texts) / (1 + texts with the bucket)), over all rows; at most BUCKETS + 1 sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for buckets, _ in _bags(batch.column(0)):
                found[buckets] += 1
            found[-1] += batch.num_rows
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": found[some]})

    total = np.zeros(BUCKETS + 1)
    for row in texts.select(_named(text)).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return np.log((1 + total[-1]) / (1 + total[:-1]))


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """A model from about sample labelled documents (documents: doc_id, text; labels: doc_id, quality 0 or 1).

    Rarity is counted over all documents. Which labelled ones are learned from is decided by a hash of doc_id over all rows
    that may be: not held out, with an id, a text and a quality. A document with several labels has their mean. Only bags of
    terms reach the driver, at most BUCKETS entries for a text. Without any such document the model knows only a prior of 0.5.
    """
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.avg("quality").alias("label")))
    known = known.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)))
    texts = documents.where(F.col("text").isNotNull()).select("doc_id", "text")
    n = known.join(texts.select("doc_id"), "doc_id").count()
    picked = texts.join(known.where(F.col("place") < F.lit(min(1.0, sample / max(1, n)) * (1 << 32))), "doc_id")

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = list(_bags(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([b.astype(np.int32) for b, _ in bags], pa.list_(pa.int32())),
                 pa.array([c.astype(np.int32) for _, c in bags], pa.list_(pa.int32()))], ["doc_id", "label", "buckets", "counts"])

    shape = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, label double, buckets array<int>, counts array<int>"
    rows = [(r["doc_id"], r["label"], np.array(r["buckets"], np.int64), np.array(r["counts"], np.int64))
            for r in picked.select("doc_id", "text", "label").mapInArrow(bag, shape).collect() if r["buckets"]]
    rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0], r[2].tobytes(), r[3].tobytes()))
    return fit([(b, c) for _, _, b, c in rows], [y for _, y, _, _ in rows], term_rarity(documents, "text"))


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def score_quality(df: DataFrame, text: str, model: QualityModel) -> DataFrame:
    """df with score (0 to 1, higher is better) and predicted (1 from GOOD on, else 0).

    A null or empty text, and one without any similar neighbour, gets the prior, the mean of the labels learned. Columns of
    these two names in any case are replaced; repeated rows get equal scores; an empty table gives none. A task holds one
    Arrow batch, its vectors and a block of cosines, however long the texts are.
    """

    @F.arrow_udf("double")
    def voted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            bags = list(_bags(texts))
            vectors = np.array([model.project(bag) for bag in bags]).reshape(len(bags), model.axes.shape[1])
            yield pa.array(model.vote(vectors), pa.float64())

    kept = [_named(c) for c in df.columns if c.lower() not in ("score", "predicted")]
    return df.select(*kept, voted(_named(text)).alias("score")).withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
