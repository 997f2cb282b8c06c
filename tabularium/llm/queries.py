"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import attribution, bpe, langid, licenses, near_vectors, ngram_join, quality, ranked_search, sharding, suffix_repeats, templates, vector_codes, warc
from tabularium.llm.license_texts import TEMPLATES

SHARD_BYTES = 1 << 20


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str) -> bytes:
    """The content of a tokenizer file."""
    return Path(public_tokenizers.path(name)).read_bytes()


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    said = langid.identify(documents.select("doc_id", "text"), "text", langid.learn(documents))
    return said.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def warc_packages(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    packages = warc.write_packages(warc.with_revisits(pages, "page_id", "payload", least=0), "page_id", "url", "payload")
    return warc.read_packages(packages).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = templates.find_leaks(_table(spark, folder, "documents").select("doc_id", "text"), "text", _table(spark, folder, "benchmark"), "item_id", "text")
    return (found.select("doc_id", F.explode_outer("leaks").alias("leak")).where("leak IS NOT NULL")
            .select("doc_id", F.col("leak.item").alias("item_id"), "leak.covered", "leak.tokens", "leak.changed_slots", "leak.first_word", "leak.last_word"))


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, folder, "documents").select("doc_id", "text"), "text", TEMPLATES)
    return found.select("doc_id", F.explode_outer("licenses").alias("found")).where("found IS NOT NULL").select("doc_id", "found.*")


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = tokenizer("byte_bpe_multi_50k.tiktoken")
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_and_decode(documents, "text", ranks, public_tokenizers.PATTERN).select(
        "doc_id", bpe.n_tokens("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def token_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.attribute(_table(spark, folder, "documents").select("doc_id", "text"), "text",
                                 tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.extendible_shards(_table(spark, folder, "documents"), "doc_id", F.octet_length("text"), SHARD_BYTES)


def near_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(_table(spark, folder, "embeddings"), "vec_id", "embedding", 0.95)


def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_repeats.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"), "doc_id", "text", 400)
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                      F.octet_length("kept").cast("long").alias("n_kept"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, folder, "documents"), "doc_id", "text", words=5, percent=80)


def quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.score_quality(documents, "text", quality.learn(documents, _table(spark, folder, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def ranked_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(_table(spark, folder, "benchmark"), "item_id", "text", _table(spark, folder, "documents"), "doc_id", "text", best=10)


def vector_code_rows(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.code_report(_table(spark, folder, "embeddings"), "vec_id", "embedding", "label")


SHARDING_SQL = f"""
WITH r AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5('k' || CAST(doc_id AS VARCHAR)), 1, 4) AS BIGINT) AS c
  FROM documents),
s AS (
  SELECT d, c >> (16 - d) AS p, sum(n_bytes) AS total, count(*) AS n
  FROM r, (SELECT unnest(range(0, 17)) AS d) GROUP BY 1, 2),
f AS (
  SELECT r.doc_id, r.n_bytes, r.c, min(s.d) AS d
  FROM r JOIN s ON s.p = r.c >> (16 - s.d)
  WHERE s.total <= {SHARD_BYTES} OR s.n = 1 GROUP BY 1, 2, 3)
SELECT f.doc_id, f.n_bytes, substr(lpad(bin(f.c), 16, '0'), 1, CAST(f.d AS BIGINT)) AS shard, CAST(f.d AS INTEGER) AS shard_bits,
       CAST(s.total AS BIGINT) AS shard_bytes
FROM f JOIN s ON s.d = f.d AND s.p = f.c >> (16 - f.d)
"""

#: ASCII letters are lowered one by one, as lower() would also change others.
SEARCH_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
c AS (SELECT count(*) AS n_documents, CAST(sum(len(words)) AS BIGINT) AS n_terms FROM d WHERE len(words) > 0),
m AS (SELECT k, doc_id, 25 + (75 * len(words) * n_documents) // n_terms AS m FROM d, c WHERE len(words) > 0),
p AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(words) AS term FROM d) GROUP BY 1, 2),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_documents + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), c),
i AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY 1, 2),
s AS (
  SELECT item_id, k, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN p USING (term) JOIN m USING (k) GROUP BY 1, 2, 3),
r AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, k) AS INTEGER) AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round assigns all parts to all entries by brute force and takes floored means, in whole numbers."""
    floored = "(s - ((s % n) + n) % n) // n"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT v.rn, v.part, min({{'d': list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': c.entry}}) AS best
  FROM v JOIN c{i} c USING (part) GROUP BY 1, 2)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT part, entry, list({floored} ORDER BY place) AS x FROM (
      SELECT part, entry, place, CAST(sum(x[place]) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT a.part, a.best.e AS entry, v.x, unnest(range(1, len(v.x) + 1)) AS place FROM a{i} a JOIN v USING (rn, part)) GROUP BY 1, 2, 3)
    GROUP BY 1, 2) m USING (part, entry))""")
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rn, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT rn, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS x FROM k, (SELECT unnest(range({parts})) AS part)),
c0 AS MATERIALIZED (SELECT part, rn - 1 AS entry, x FROM v WHERE rn <= {entries}),
{", ".join(steps)},
o AS (SELECT rn, string_agg(lower(printf('%02x', best.e)), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY 1),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM o JOIN k USING (rn), h
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id,
    "op2_warc_packages": warc_packages,
    "op3_template_decontamination": template_decontamination,
    "op4_byte_bpe": byte_bpe,
    "op5_token_attribution": token_attribution,
    "op6_near_embeddings": near_embeddings,
    "op7_suffix_dedup": suffix_dedup,
    "op8_extendible_sharding": extendible_sharding,
    "op9_ngram_jaccard": ngram_jaccard,
    "op10_license_scan": license_scan,
    "op11_quality_votes": quality_votes,
    "op12_ranked_search": ranked_lexical,
    "op13_vector_codes": vector_code_rows,
}
ORACLES: dict[str, str] = {
    "op8_extendible_sharding": SHARDING_SQL,
    "op12_ranked_search": SEARCH_SQL,
    "op13_vector_codes": _codes_sql(),
}
