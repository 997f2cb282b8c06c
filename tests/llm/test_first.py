"""Language ID, BPE, attribution and sharding on small inputs and against brute force."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabularium.llm import attribution, bpe, langid, queries, sharding

SMALL = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module", params=["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def pair(request):
    ranks = bpe.load_ranks(queries.tokenizer(request.param))
    return bpe.Encoder(ranks, PATTERN), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


PIECES = st.one_of(st.text(max_size=60), st.text("aeinrst hAE0159\n\té", max_size=80), st.sampled_from(["a", " ", "\n", "0", "é"]).map(lambda c: c * 300))


@settings(max_examples=300, deadline=None)
@given(text=PIECES)
def test_ids_are_those_of_the_library(pair, text):
    own, other = pair
    assert np.frombuffer(own.encode(text), "<u4").tolist() == other.encode_ordinary(text)


def test_ids_of_documents(spark, pair):
    own, other = pair
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect():
        assert np.frombuffer(own.encode(row.text), "<u4").tolist() == other.encode_ordinary(row.text or "")


@given(data=st.binary(max_size=40), cuts=st.lists(st.integers(0, 40)))
def test_streaming_decode_of_valid_and_cut_text(data, cuts):
    text = data.decode("latin-1") + "é€😀"
    raw, stream, at, out = text.encode(), bpe.Utf8Stream(), 0, []
    for cut in sorted(cuts):
        out.append(stream.feed(raw[at:max(at, cut)]))
        at = max(at, cut)
    assert "".join([*out, stream.feed(raw[at:]), stream.close()]) == text


def test_bpe_round_trip_and_nulls(spark):
    ranks = queries.tokenizer("byte_bpe_multi_50k.tiktoken")
    df = spark.createDataFrame([(1, "Grüße, 😀 world", "x"), (2, "", "y"), (3, None, None), (3, None, None)], "doc_id long, text string, ids string")
    rows = bpe.decode(bpe.encode(df, "text", ranks, PATTERN), "ids", ranks).collect()
    assert [(r.doc_id, r.decoded, len(r.ids) > 0) for r in rows] == [(1, "Grüße, 😀 world", True), (2, "", False), (3, "", False), (3, "", False)]
    assert bpe.encode(df.limit(0), "text", ranks, PATTERN).collect() == []
    both = bpe.encode_and_decode(df.withColumn("Decoded", F.lit(1)).withColumn("_said", F.lit(2)), "text", ranks, PATTERN)
    assert both.columns == ["doc_id", "text", "_said", "ids", "decoded"] and [(r.doc_id, r.decoded, r.ids) for r in both.collect()] == [(r.doc_id, r.decoded, r.ids) for r in rows]
    assert bpe.encode_and_decode(df.limit(0), "text", ranks, PATTERN).collect() == []


def test_bpe_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(queries.tokenizer("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    rows = queries.byte_bpe(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = np.array(other.encode_ordinary(docs[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_attribution_by_characters(spark):
    rank_lines = queries.tokenizer("byte_bpe_50k.tiktoken")
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(rank_lines), special_tokens={})
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    docs |= {-1: "a\n\n\nb 😀😀\n", -2: "", -3: None, -4: "\n"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = defaultdict(list)
    for r in attribution.attribute(df, "text", rank_lines, PATTERN).collect():
        got[r.doc_id].append((r.section, r.section_start, r.section_end, r.n_tokens, r.n_crossing))
    for doc_id, text in docs.items():
        parts = (text or "").splitlines(keepends=True) if "\r" not in (text or "") else None
        parts = [p for p in (text or "").replace("\n", "\n\0").split("\0") if p]
        section_of, want, at = [], [], 0
        for i, part in enumerate(parts):
            section_of += [i] * len(part)
            want.append([i, at, at + len(part), 0, 0])
            at += len(part)
        first = np.cumsum([0] + [len(c.encode()) for c in text or ""])
        place = 0
        for token in other.encode_ordinary(text or ""):
            end = place + len(other.decode_single_token_bytes(token))
            chars = range(np.searchsorted(first, place, "right") - 1, np.searchsorted(first, end, "left"))
            own = [section_of[c] for c in chars]
            best = max(sorted(set(own)), key=own.count)
            want[best][3] += 1
            want[best][4] += len(set(own)) > 1
            place = end
        assert got[doc_id] == [tuple(w) for w in want]


def test_tokens_outside_sections():
    owner, crossing = attribution.allocate((np.array([0, 2, 5, 8]), np.array([2, 5, 8, 9])), (np.array([1, 4]), np.array([4, 6])))
    assert owner.tolist() == [0, 0, 1, -1] and crossing.tolist() == [True, True, True, False]


def test_shards_by_brute_force(spark):
    rows = [(i % 37 if i % 3 else 5, i % 50 + 1) for i in range(600)] + [(None, None), (999, 5000)]
    df = spark.createDataFrame(rows, "doc_id long, size long")
    got = sharding.extendible_shards(df, "doc_id", F.col("size"), 400).collect()
    assert sorted((r.doc_id or -1, r.n_bytes) for r in got) == sorted((k or -1, s or 0) for k, s in rows)
    sums = defaultdict(list)
    for r in got:
        sums[r.shard].append(r.n_bytes)
        assert len(r.shard) == r.shard_bits
        if r.doc_id is not None and r.shard_bits <= 64:
            path = bin(int("1" + hashlib.md5(f"k{r.doc_id}".encode()).hexdigest()[:16], 16))[3:]
            assert path.startswith(r.shard)
    assert all(sum(v) <= 400 or len(v) == 1 for v in sums.values())
    assert {r.shard: r.shard_bytes for r in got} == {k: sum(v) for k, v in sums.items()}
    assert not any(a != b and b.startswith(a) for a in sums for b in sums)
    parents = defaultdict(int)
    for shard, sizes in sums.items():
        for i in range(len(shard)):
            parents[shard[:i]] += sum(sizes)
    assert all(v > 400 for v in parents.values())


def test_shards_of_nothing(spark):
    assert sharding.extendible_shards(spark.createDataFrame([], "doc_id long, size long"), "doc_id", F.col("size"), 10).collect() == []


def test_language_accuracy_and_rejection(spark):
    rows = queries.language_id(spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_training_settles_on_a_large_sample(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.learn(documents)
    assert abs(model.table).max() < 1000 and 0 < model.threshold <= langid.CEILING
    rows = documents.where(langid.held_out(F.col("doc_id"))).select("text", "lang").collect()
    said = [(*model.predict(r.text), r.lang) for r in rows]
    assert sum(a == b for a, _, b in said) >= 0.97 * len(said)
    assert sum(p < model.threshold for _, p, _ in said) <= 0.002 * len(said)


def test_language_of_odd_texts(spark):
    model = langid.train(["the and of"] * 20 + ["der und die"] * 20, ["en"] * 20 + ["de"] * 20)
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "123 $$ ½", "c"), (4, "the of", "d"), (5, "the of" * 9999, "e")], "doc_id long, text string, score string")
    rows = {r.doc_id: r for r in langid.identify(df, "text", model).collect()}
    assert [rows[i].lang_pred for i in range(1, 6)] == ["und", "und", "und", "en", "en"]
    assert [rows[i].rejected for i in range(1, 4)] == [True] * 3 and not rows[5].rejected
    assert langid.identify(df.limit(0), "text", model).collect() == []
    with pytest.raises(ValueError):
        langid.train([], [])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_their_sql(spark, name):
    from tests.compare import duck

    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, folder).toPandas()
    want = duck(folder).execute(queries.ORACLES[name]).df()[list(got.columns)]
    assert sorted(map(tuple, got.itertuples(index=False))) == sorted(map(tuple, want.itertuples(index=False)))
