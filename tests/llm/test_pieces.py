from __future__ import annotations

import hashlib
import random
from itertools import chain

import pytest
from sentencepiece import SentencePieceProcessor

from tillwatch.llm import pieces


@pytest.fixture(scope="module")
def both():
    return pieces.Pieces(pieces.model_path()), SentencePieceProcessor(model_file=pieces.model_path())


def same(both, text):
    own, library = both
    ids = list(chain.from_iterable(own.encoded(text)))
    want = library.encode(text, add_eos=True)
    assert ids == want
    assert "".join(own.decoded(iter([ids]))) == library.decode(want)


@pytest.mark.parametrize("text", [
    "", " ", "   ", " a  b ", "It's 42 o'clock.", "a▁b ▁", "<0x41><s></s><unk>", "\0a\0", "\n\t\r\n", "가字\U0001f600 \U0001f600x",
    "é ﻿  ", "abcdefgh" * 500, "a" * 5000, " " * 3000 + "x", "aaaaab" * 300, "=" * 999, "thethethe" * 200,
])
def test_texts_like_the_library(both, text):
    same(both, text)


@pytest.mark.parametrize("letters", ["ab", "the", "tion esa", " \n=-", "abcdefghijklmnopqrstuvwxyz   ", "éüßñçø ", "字가ا日本 \U0001f600"])
def test_random_texts_like_the_library(both, letters):
    chance = random.Random(letters)
    for _ in range(600):
        same(both, "".join(chance.choices(letters, k=chance.randrange(60))))


def test_slices_are_cut_between_words(both, monkeypatch):
    chance = random.Random(3)
    texts = ["".join(chance.choices("abc  ▁\n字\U0001f600", k=200)) for _ in range(200)]
    monkeypatch.setattr(pieces, "SLICE", 7)
    for text in texts:
        same(both, text)


def test_any_ids_decode_like_the_library(both):
    own, library = both
    chance = random.Random(4)
    for _ in range(500):
        ids = [chance.choice([chance.randrange(3, 259), chance.randrange(1, 32000)]) for _ in range(chance.randrange(12))]
        assert "".join(own.decoded(iter([ids]))) == library.decode(ids)


def test_a_longer_piece_is_given_up_where_merges_go_otherwise(both):
    own, _ = both
    greedy = 0
    chance = random.Random(5)
    for _ in range(500):
        word = "".join(chance.choices("estioner", k=12))
        first = next(own.pieces[at] for at in own._encode_word(word))
        longest = max((piece for piece in own.ids if word.startswith(piece)), key=len)
        greedy += first != longest
    assert greedy > 50


def test_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (None, "", "x"), (2**62 + 1, "A cat.", "x"), (3, "A cat.", "x"), (3, "A cat.", "x")],
        "doc_id long, text string, ids string")
    found = {row["doc_id"]: row for row in pieces.round_trip(docs).collect()}
    assert found[1][1:] == found[None][1:] == (1, hashlib.sha256(b"2").hexdigest(), hashlib.sha256(b"").hexdigest())
    assert found[2**62 + 1]["decoded_sha256"] == hashlib.sha256(b"A cat.").hexdigest()
    assert pieces.round_trip(docs).count() == 5 and pieces.round_trip(docs.limit(0)).count() == 0
    assert sorted(row["text"] for row in pieces.decode(pieces.encode(docs)).collect()) == ["", "", "A cat.", "A cat.", "A cat."]


def test_a_very_long_text_is_held_in_slices(both):
    import tracemalloc

    text = "some words, again and again; " * 200_000
    own, library = both
    list(own.encoded(text[:1000]))
    tracemalloc.start()
    count = sum(map(len, own.encoded(text)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == len(library.encode(text, add_eos=True)) and peak < 60 << 20
