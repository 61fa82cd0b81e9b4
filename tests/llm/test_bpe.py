from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer as Library

from tillwatch.llm import bpe


@pytest.fixture(scope="module")
def both():
    return bpe.Tokenizer(bpe.vocabulary_path()), Library.from_file(bpe.vocabulary_path())


def same(both, text):
    own, library = both
    encoded = library.encode(text, add_special_tokens=False)
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == encoded.ids
    assert own.decode(ids) == library.decode(encoded.ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", " \n\t", "It's 42 o'clock, isn't it?", "ΑΣ Σ ς İ ſ K Å", "e\u0301 가", "<|endoftext|>a<|startoftext|> <|x|>", "😀\x1c\x85\u00a0z",
    "abcdefgh" * 2000, "'LL'd'Re" * 20,
])
def test_texts_like_the_library(both, text):
    same(both, text)


def test_random_texts_like_the_library(both):
    chance = random.Random(1)
    letters = [chr(code) for code in range(32, 0x180)] + ["<|endoftext|>", "'s", "\u3000", "\u0301", "字", "ا"]
    for _ in range(3000):
        same(both, "".join(chance.choice(letters) for _ in range(chance.randrange(40))))


def test_scan_and_heap_merge_alike(both):
    chance = random.Random(2)
    for _ in range(300):
        parts = [both[0].letters[chance.choice(b"theanigo")] for _ in range(chance.randrange(1, 80))]
        assert both[0]._merge_by_scan(parts[:]) == both[0]._merge_by_heap(parts[:])


def test_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (None, "", "x"), (2**62 + 1, "A cat.", "x"), (3, "A cat.", "x"), (3, "A cat.", "x")],
        "doc_id long, text string, ids string")
    found = {row["doc_id"]: row for row in bpe.round_trip(docs).collect()}
    assert found[1]["n_tokens"] == found[None]["n_tokens"] == 0
    assert found[1]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert found[2**62 + 1]["decoded_sha256"] == hashlib.sha256(b"a</w> cat</w> .</w>").hexdigest()
    assert bpe.round_trip(docs).count() == 5 and bpe.round_trip(docs.limit(0)).count() == 0
    assert {row["text"] for row in bpe.decode(bpe.encode(docs)).collect()} == {"", "a</w> cat</w> .</w>"}
