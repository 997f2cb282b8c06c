"""A corpus pipeline of five stages over documents.

Each stage takes (spark, docs, sf_dir), works on all rows of docs and returns a DataFrame; run() writes it as Parquet below
the shared folder and reads it again for the next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import bpe, langid, ngram_join, suffix_repeats, templates
from tabularium.llm.queries import tokenizer
from tabularium.session import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; those without a letter and those below the threshold go."""
    said = langid.identify(docs.select(*COLUMNS), "text", langid.learn(docs))
    return said.where(~F.col("rejected")).select(*COLUMNS)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id, nulls last; of equal ids, one of them.

    Null, shared and repeated ids are decided row by row. A text without words has no copies, and its row stays. Where every
    row has an id of its own, the id tells rows apart and docs is read where it is; else rows are numbered and written.
    """
    rows = docs.select(*COLUMNS)
    shared = rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if dict(rows.dtypes)["doc_id"] == "bigint" and not shared.head(1):
        rows = rows.withColumn("__row", F.col("doc_id"))
    else:
        rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered-rows")
    groups = ngram_join.jaccard_components(rows, "__row", "text", words=5, percent=80)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row"))
    kept = (groups.join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(F.min(order).alias("first"))
            .select(F.col("first.__row").alias("__row")))
    return rows.join(kept, "__row", "left_semi").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 400 bytes that occur elsewhere. A document stays, though its text may be empty.

    A character that a cut would split stays whole.
    """
    cut = suffix_repeats.remove_repeats(docs.select(*COLUMNS), "doc_id", "text", 400, whole_characters=True)
    text = F.when(F.col("text").isNotNull(), F.col("kept").cast("string"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return templates.find_leaks(docs, "text", benchmark, "item_id", "text").where(F.size("leaks") == 0).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and whether decoding them gives the text back."""
    ranks = tokenizer("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_and_decode(docs, "text", ranks, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "lang", "source", bpe.n_tokens("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", join_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]

#: No stage but the last can be said in SQL; tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
