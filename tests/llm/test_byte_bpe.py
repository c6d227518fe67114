from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deedlens.llm import byte_bpe, queries

SF_DIR = "/root/testdata/sf0.001"


def library(name):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(name))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def both(request):
    return byte_bpe.codec(public_tokenizers.path(request.param)), library(request.param)


def same(both, text):
    codec, expected = both
    ids = memoryview(codec.encode(text)).cast("i").tolist()
    assert ids == expected.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@given(st.text(max_size=60))
@settings(max_examples=500, deadline=None)
def test_any_text(both, text):
    same(both, text)


@given(st.text(alphabet="aeiount 'sT12\n\t\x1c é中 #.-", max_size=80))
@settings(max_examples=1000, deadline=None)
def test_crowded_text(both, text):
    same(both, text)


def test_pieces_of_random_bytes_of_the_vocabulary(both):
    codec, expected = both
    rng = random.Random(1)
    entries = [t.decode() for t in codec.ranks if t.isalpha() and t.isascii()]
    for _ in range(3000):
        same(both, "".join(rng.choices(entries, k=rng.randrange(1, 9))))


def test_long_runs(both):
    for unit in ("a", "ab", " ", "\n", "é", "-=", "中"):
        same(both, unit * 5000)
    same(both, "x" * 300_000)


def test_query(spark):
    found = {r.doc_id: r for r in queries.QUERIES["op7_byte_bpe"](spark, SF_DIR).collect()}
    expected = library(byte_bpe.RANKS)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(documents)
    for doc_id, text in documents:
        ids = expected.encode_ordinary(text or "")
        assert found[doc_id].n_tokens == len(ids)
        assert found[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string")
    ids = df.select(byte_bpe.encode(F.col("text")).alias("ids"))
    assert [r.ids for r in ids.collect()] == [[], [], []]
    assert [bytes(r[0]) for r in ids.select(byte_bpe.decode(F.col("ids"))).collect()] == [b"", b"", b""]
    assert [tuple(r[0]) for r in df.select(byte_bpe.round_trip(F.col("text"))).collect()] == [([], b"")] * 3
    assert df.limit(0).select(byte_bpe.encode(F.col("text"))).count() == 0
