from __future__ import annotations

import hashlib
import random
import re
import time
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest

from tillwatch.llm import catalog, periodic


def smallest_period(words):
    return next(p for p in range(1, len(words) + 1) if words[p:] == words[:len(words) - p])


def brute(words, least=lambda period: max(6, 4 * period)):
    """Every maximal stretch, tried by its start and end."""
    found = []
    for start in range(len(words)):
        for stop in range(start + 1, len(words) + 1):
            period = smallest_period(words[start:stop])
            if stop - start < least(period):
                continue
            before = start and words[start - 1] == words[start - 1 + period]
            after = stop < len(words) and words[stop] == words[stop - period]
            if not before and not after:
                found.append((start, stop - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize("kinds", [1, 2, 3, 5])
def test_runs_like_trying_all_stretches(kinds):
    chance = random.Random(kinds)
    for _ in range(60):
        words = chance.choices("abcdefgh"[:kinds], k=chance.randrange(26))
        if chance.random() < 0.6 and words:
            words += words[-chance.randrange(1, 6):] * chance.randrange(1, 6)
        assert periodic.find_runs(words) == brute(words)
        ids = [ord(word) for word in words]
        assert sorted(periodic.all_runs(ids)) == sorted(brute(words, lambda period: 2 * period))


def test_squares_are_met_once_by_their_smallest_period():
    chance = random.Random(7)
    for _ in range(200):
        words = chance.choices([1, 2, 3], k=chance.randrange(40))
        want = {
            (end, half) for end in range(len(words)) for half in range(1, (end + 1) // 2 + 1)
            if words[end + 1 - half:end + 1] == words[end + 1 - 2 * half:end + 1 - half]
            and not any(half % own == 0 and words[end + 1 - half:end + 1] == words[end + 1 - half:end + 1 - half + own] * (half // own)
                        for own in range(1, half))
        }
        found = list(periodic.squares(words))
        assert len(found) == len(set(found)) and set(found) == want


def test_cutting_loses_no_run():
    chance = random.Random(8)
    for _ in range(300):
        words = []
        while len(words) < 60:
            words += chance.choice([chance.choices("abcdefghijklm", k=5), chance.choices("abc", k=chance.randrange(1, 4)) * chance.randrange(3, 7)])
        ids = np.array([ord(word) for word in words], np.int32)
        whole = {run for run in periodic.all_runs(ids.tolist()) if run[1] >= max(6, 4 * run[2])}
        assert set(periodic.find_runs(words)) == whole


def test_kept_words_and_the_densest_run():
    words = "x a b a b a b a b y z z z z z z".split()
    found = periodic.find_runs(words)
    assert found == [(1, 8, 2), (10, 6, 1)]
    assert periodic.kept_words(words, found) == "x a b y z".split()
    assert periodic.densest(found) == (10, 6, 1)
    assert periodic.densest([(0, 8, 2), (9, 12, 3)]) == (0, 8, 2) and periodic.densest([]) is None


@pytest.mark.parametrize("words", [
    ["w"] * 20_000, ["a", "b"] * 10_000, [str(at % 2500) for at in range(20_000)],
    ["ab"[bin(at).count("1") % 2] for at in range(20_000)],
])
def test_long_repetitive_texts_take_no_square_of_their_length(words):
    before = time.process_time()
    found = periodic.find_runs(words)
    assert time.process_time() - before < 20
    assert all(length >= 4 * period for _, length, period in found)
    if len(set(words)) != 2 or words[:4] == ["a", "b"] * 2:
        assert found == [(0, 20_000, len(set(words)))]


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seed = crc32(str(doc_id).encode())
    if seed % 10 or not words:
        return words
    g, n = seed // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def test_query_like_trying_all_stretches(spark, tmp_path):
    chance = random.Random(9)
    rows = [(doc_id, " ".join(chance.choices("abcdefghijklmnop", k=chance.randrange(40)))) for doc_id in range(400)]
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "w\x85x y " * 7), (504, "b a " * 9), (504, "b a " * 9), (None, "c " * 9)]
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id long, text string, _tail string, start int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted(map(tuple, catalog.op12_periodic(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        words = planted(doc_id, text) if doc_id is not None else (text or "").split()
        own = brute(words)
        best = max(own, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=None)
        dropped = {at for s, n, p in own for at in range(s + p, s + n)}
        kept = " ".join(word for at, word in enumerate(words) if at not in dropped)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in own)
        want.append((
            doc_id, len(own), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    assert found == sorted(want, key=repr)
    assert sum(row[1] for row in found) > 10


def test_rows(spark):
    docs = spark.createDataFrame([(1, "a b a b a b a b c", 0), (2, None, 0), (3, "", 0)], "doc_id long, text string, length int")
    assert [tuple(row) for row in periodic.runs(docs).collect()] == [(1, 0, 8, 2)]
    assert {tuple(row) for row in periodic.collapse(docs).collect()} == {(1, "a b c"), (2, ""), (3, "")}
    assert periodic.report(docs.limit(0)).count() == periodic.runs(docs.limit(0)).count() == 0
