from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from deedlens.llm import packing, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def coded(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@given(st.text(max_size=50) | st.text(alphabet="aAéÉß'st1 .,\n\t\x0b́\xa0İΣ<|#", max_size=60))
@settings(max_examples=1500, deadline=None)
def test_encoder(tokenizer, text):
    own = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    assert list(own.encode_all([text])) == [coded(plain(tokenizer, text)[:-1])]


def test_special_tokens_in_a_text(tokenizer):
    own = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    for text in ("hello <|endoftext|> world", "a<|endoftext|>b <|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|> <| endoftext |>"):
        assert list(own.encode_all([text])) == [coded(plain(tokenizer, text)[:-1])]
    assert list(own.encode_all(["hello <|endoftext|> world"])) == [coded([3306, 49407, 1002])]


def check(rows, texts, tokenizer):
    """Pieces per document and sequence, against plain encoding."""
    cuts = defaultdict(list)
    for r in rows:
        cuts[r.doc_id].append(r)
    assert set(cuts) == set(texts)
    for doc_id, found in cuts.items():
        ids = plain(tokenizer, texts[doc_id])
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(coded(ids[at : at + r.length]))
            assert r.length <= 4096 and r.length & (r.length - 1) == 0 and r.offset == 0
            at += r.length
        assert at == len(ids)
        assert len(found) == len(ids) // 4096 + bin(len(ids) % 4096).count("1")
    order = sorted(rows, key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in order] == list(range(len(rows)))
    assert [r.length for r in order] == sorted(r.length for r in rows)


def test_words_are_learnt_once_and_without_offsets(tokenizer):
    own = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    learnt = []

    class Fast:
        def encode_batch_fast(self, found, add_special_tokens):
            learnt.extend(found)
            return merges.encode_batch_fast(found, add_special_tokens=add_special_tokens)

    merges, own.merges = own.merges, Fast()
    lines = ["Red red, green RED", "green " + "w" * 100 + " red."]
    assert list(own.encode_all(lines)) == [coded(plain(tokenizer, t)[:-1]) for t in lines]
    assert sorted(" ".join(learnt).split()) == ["green", "red", "w" * 100]
    # Long chunks are not kept.
    assert "green" in own.chunks and "w" * 100 not in own.chunks


def test_query(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    check(queries.QUERIES["op1_packing"](spark, SF_DIR).collect(), texts, tokenizer)


def test_edges(spark, tokenizer):
    texts = {1: None, 2: "", 3: " \n ", 4: "one", 5: "word " * 4095, 6: "word " * 4096, 7: "a, b " * 9000, 8: "é" * 5000, None: "x y"}
    df = spark.createDataFrame([(k, v, 1, "x") for k, v in texts.items()], "doc_id long, text string, length int, ids string")
    check(packing.packed(df).collect(), texts, tokenizer)
    rows = packing.packed(df, keep_ids=True).where("doc_id = 7").orderBy("start").collect()
    assert b"".join(bytes(r.ids) for r in rows) == coded(plain(tokenizer, texts[7]))
    short = packing.packed(df, longest=1).where("doc_id = 4").collect()
    assert len(short) == len(plain(tokenizer, "one"))
    twice = packing.packed(df.union(df))
    assert twice.count() == 2 * packing.packed(df).count() == twice.select("sequence_id").distinct().count()
    assert packing.packed(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(df, longest=3)
