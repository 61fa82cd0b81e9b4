from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tillwatch.llm import ngram_join


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda own: own[0].lower(), text or ""))
    return {tuple(words[at:at + n]) for at in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute(rows):
    sets = [(doc_id, shingles(text)) for doc_id, text in rows if doc_id is not None]
    group = {doc_id: doc_id for doc_id, _ in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for at, (a, one) in enumerate(sets):
        for b, other in sets[:at]:
            if one and other and 100 * len(one & other) >= 80 * len(one | other):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return sorted([(doc_id, len(own), root(doc_id)) for doc_id, own in sets])


def near_copies(seed, groups=12, copies=8):
    """Groups of texts that differ in a few words, some of them around the threshold."""
    chance = random.Random(seed)
    word = lambda: "".join(chance.choice("abcdefg") for _ in range(chance.randrange(1, 5)))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(chance.choice([3, 5, 6, 12, 60, 200]))] + (passage if chance.random() < 0.5 else [])
        for _ in range(copies):
            own = base[:]
            for _ in range(chance.randrange(0, 1 + len(own) // 30)):
                own[chance.randrange(len(own))] = word()
            rows.append((len(rows) * 7 % 1009, chance.choice([" ", "\n", "\t "]).join(own)))
    return rows


@pytest.mark.parametrize("seed, hot, chunk", [(1, ngram_join.HOT, 256), (2, 3, 256), (3, ngram_join.HOT, 4)])
def test_like_brute_force(spark, monkeypatch, seed, hot, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    rows = near_copies(seed)
    found = ngram_join.classified(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), hot=hot)
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_unusual_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "q"), (2, "", "q"), (3, "a b", "q"), (4, "A  b", "q"), (None, "a b", "q"), (3, "a b", "q"),
         (9, " ".join(map(str, range(30_000))), "q"), (8, " ".join(map(str, range(29_990))), "z")],
        "doc_id long, text string, key string")
    found = {(row["doc_id"], row["n_shingles"], row["component_id"]) for row in ngram_join.classified(docs).collect()}
    assert found == {(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (None, 1, None), (9, 29_996, 8), (8, 29_986, 8)}
    assert ngram_join.classified(docs.limit(0)).count() == 0
    kept = ngram_join.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(row["doc_id"] or 0 for row in kept.collect()) == [0, 1, 2, 3, 8]


def test_an_id_with_several_texts(spark):
    """Each text of a repeated id belongs to its own group, and no row is lost that is like no other."""
    a, b = (" ".join(f"{name}{at}" for at in range(60)) for name in "ab")
    docs = spark.createDataFrame(
        [(1, a, "x"), (1, b, "x"), (2, a + " tail", "x"), (5, b + " end", "x"), (7, "", "y"), (7, None, "y"), (8, a, "z"), (1, a, "w")],
        "doc_id long, text string, label string").repartition(3)
    found = sorted((row["doc_id"], row["component_id"], row["n_shingles"]) for row in ngram_join.classified(docs).collect())
    assert found == [(1, 1, 56), (1, 1, 56), (1, 1, 56), (2, 1, 57), (5, 1, 57), (7, 7, 0), (7, 7, 0), (8, 1, 56)]
    for partitions in (1, 4):
        kept = ngram_join.without_near_copies(docs.repartition(partitions)).collect()
        assert sorted(map(tuple, kept), key=repr) == sorted(
            [(1, a, "w"), (1, b, "x"), (7, "", "y"), (7, None, "y")], key=repr)


def test_a_very_long_text_is_hashed_in_pieces(monkeypatch):
    import tracemalloc

    grams_of = ngram_join.Grams(5)
    text = " ".join(f"word{at % 9999}" for at in range(3_000_000))
    tracemalloc.start()
    found = grams_of(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 27 MB of text: its bytes, and some 40 bytes a word.
    assert len(found) == 9_999 and peak < 250 << 20 and grams_of.powers.nbytes <= 32 * ngram_join.PIECE_BYTES
    short = "A b\x0b c " * 200 + "x" * 5_000 + " d e f g"
    whole = grams_of(short)
    monkeypatch.setattr(ngram_join, "PIECE_BYTES", 7)
    assert (ngram_join.Grams(5)(short) == whole).all()


def test_filters_lose_no_pair():
    chance = np.random.default_rng(5)
    for _ in range(40):
        base = chance.integers(0, 2**63, chance.integers(1, 400), dtype=np.int64).astype(np.uint64)
        sets = []
        for _ in range(12):
            own = base.copy()
            change = chance.random(len(own)) < chance.choice([0, 0.05, 0.1, 0.2])
            own[change] = chance.integers(0, 2**63, change.sum(), dtype=np.int64).astype(np.uint64)
            sets.append(np.unique(own))
        alike = {
            (i, j) for i in range(12) for j in range(i + 1, 12)
            if 100 * len(common := np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]) - len(common))
        }
        assert set(zip(*map(np.ndarray.tolist, ngram_join.linked_pairs(sets)))) == alike
        sizes = np.array([len(own) for own in sets])
        i, j = ngram_join._possible(sizes, [ngram_join.signature(own) for own in sets], None, 80)
        assert alike <= {(min(pair), max(pair)) for pair in zip(i.tolist(), j.tolist())}


def test_components(spark):
    chance = random.Random(4)
    pairs = [(chance.randrange(300), chance.randrange(300)) for _ in range(250)] + [(at, at + 1) for at in range(2000, 2060)]
    pairs = [(min(pair), max(pair)) for pair in pairs if pair[0] != pair[1]]
    group = {}

    def root(x):
        group.setdefault(x, x)
        while group[x] != x:
            x = group[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        group[y] = x
    found = ngram_join.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {row["id"]: row["component"] for row in found} == {x: root(x) for x in group}
