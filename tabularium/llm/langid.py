"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text is lowered, runs of other than letters become one space, and its pairs and triples of characters are hashed to
buckets. Embeddings of the buckets are averaged and a linear softmax reads the average; both are trained by stochastic
gradient descent in numpy. As all of it is linear up to the softmax, the trained model is one table of buckets by languages.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from tabularium.llm.batches import small_batches
from tabularium.llm.names import free_names, without

UNKNOWN = "und"
BUCKET_BITS, DIMENSIONS, ORDERS = 15, 16, (2, 3)
#: Training documents per language (in expectation), and the share of them kept for calibration.
SAMPLE, CALIBRATION = 1000, 0.2
#: The confidence below which a text is rejected is at most CEILING, or OVER times that of a blind guess where this is more, and
#: rejects at most the share LOSS of right calibration texts.
CEILING, OVER, LOSS = 0.4, 1.2, 0.001
_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)
    return _LETTER


def subwords(text: str | None) -> np.ndarray:
    """Bucket numbers of the text's subwords; empty without a letter."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[np.minimum(code, 0x10FFFF)]
    if not letter.any():
        return np.empty(0, np.int64)
    code = np.where(letter, code, 32).astype(np.uint64)
    keep = np.ones(len(code), bool)
    keep[1:] = letter[1:] | letter[:-1]
    code = np.concatenate([[np.uint64(32)], code[keep], [np.uint64(32)]])
    out = []
    for order in ORDERS:
        if len(code) >= order:
            h = np.full(len(code) - order + 1, np.uint64(order))
            for i in range(order):
                h = (h ^ code[i:len(code) - order + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            out.append(h >> np.uint64(64 - BUCKET_BITS))
    return np.concatenate(out).astype(np.int64)


@dataclass
class LanguageModel:
    """languages and the bucket table; temperature calibrates the score, threshold rejects."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str | None) -> np.ndarray | None:
        buckets = subwords(text)
        return self.table[buckets].mean(axis=0, dtype=np.float64) + self.bias if len(buckets) else None

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; und and 0 without a letter, or where the model has no language."""
        logits = self.logits(text) if self.languages else None
        if logits is None:
            return UNKNOWN, 0.0
        p = _softmax(logits / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(texts: list[str], labels: list[str], epochs: int = 4, rate: float = 1.0, seed: int = 7) -> LanguageModel:
    """Fit by stochastic gradient descent, one text a step; then calibrate on texts that were kept apart."""
    languages = sorted(set(labels))
    if not languages:
        raise ValueError("no labelled text to learn from")
    data = [(np.unique(b, return_counts=True), languages.index(y)) for b, y in zip(map(subwords, texts), labels, strict=True) if len(b)]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(data))
    held = order[:int(len(data) * CALIBRATION)]
    fit = order[len(held):]
    e = rng.normal(0, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS))
    w, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    for epoch in range(epochs):
        for at, i in enumerate(rng.permutation(fit)):
            (ids, counts), y = data[i]
            share = counts / counts.sum()
            hidden = share @ e[ids]
            error = _softmax(hidden @ w + bias)
            error[y] -= 1
            step = rate * (1 - (epoch + at / max(1, len(fit))) / epochs)
            back = w @ error
            back /= max(1.0, float(np.linalg.norm(back)))
            w -= step * np.outer(hidden, error)
            bias -= 0.1 * step * error
            # Scaled by the shares, so that a step moves the average by the same length for short and long texts.
            e[ids] -= np.outer(0.1 * step * share / (share @ share), back)
    model = LanguageModel(languages, (e @ w).astype(np.float32), bias)
    _calibrate(model, [data[i] for i in held])
    return model


def _calibrate(model: LanguageModel, held: list) -> None:
    """Temperature by likelihood on the texts kept apart; threshold by the loss of right answers there."""
    if not held:
        return
    logits = np.array([(counts / counts.sum()) @ model.table[ids] + model.bias for (ids, counts), _ in held])
    truth = np.array([y for _, y in held])

    def probabilities(t: float) -> np.ndarray:
        x = logits / t
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return x / x.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.1, 10, 41)
    loss = [-np.log(np.maximum(probabilities(t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = probabilities(model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    model.threshold = float(min(max(CEILING, OVER / len(model.languages)), np.quantile(right, LOSS))) if len(right) else 0.0


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(documents: DataFrame, per_language: int = SAMPLE) -> LanguageModel:
    """A model from at most about per_language labelled texts of each language.

    Which ones is decided by a hash of doc_id, over all rows that may be learned from: labelled, with text, not held out.
    The bound on what reaches the driver is per_language times the number of languages. Where no such text has a letter, the
    model has no language and says und, 0 and rejected of every text. With one language, every text with a letter passes.
    """
    allowed = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                              & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    counts = {r["lang"]: r["n"] for r in allowed.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(None).cast("double")
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    rows = sorted(map(tuple, allowed.where(place < share * (1 << 32)).collect()), key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0], r[1]))
    rows = [r for r in rows if len(subwords(r[1]))]
    if not rows:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros(0))
    return train([r[1] for r in rows], [r[2] for r in rows])


def identify(df: DataFrame, text: str, model: LanguageModel) -> DataFrame:
    """df with lang_pred, score and rejected.

    A text that is null or has no letter gets und, 0 and rejected, and so does every text if the model has no language; every other text gets a learned language, its calibrated
    probability, and is rejected where that is below the model's threshold. Columns of these names are replaced; repeated
    rows and an empty table pass as they are. The model has a fixed number of buckets and travels with the task.
    """

    small_batches(df.sparkSession)

    @pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    kept, (said,) = without(df, ("lang_pred", "score", "rejected")), free_names(df, "_said")
    return (df.select(*kept, predicted(F.col(text)).alias(said))
            .select(*kept, f"{said}.lang_pred", f"{said}.score")
            .withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("score") < model.threshold)))
