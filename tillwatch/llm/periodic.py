"""Periodic runs: stretches of words that repeat themselves at once, and texts without the repetition.

A run is a stretch of words with smallest period q (words q apart are identical) and at least max(6, 4 q) words that no
neighbouring word extends keeping the period.

Words are appended to a suffix automaton. Its suffix-link tree is held as a link-cut tree whose preferred paths are the
strings that ended last at the same place. Appending a word makes the path from its state to the root the newest such
segment, and passes the segments it consisted of: a segment of lengths (m, n] that ended d words ago is a repeat of d words
right after themselves, a square, where m < d <= n. Every square is met this way, by its smallest period and at its first
end, and is widened to its run by comparing words d apart. Segments passed are logarithmic in number on average, so the
time does not grow with the square of a text's length, whatever the text.

Before that a text is cut where no run can be. In a run each word stands at least four times and each row of three
words at least three times, so a word or row found less often in a stretch ends the stretch there, again and again until
nothing changes. Most texts are cut away whole; what is left takes the automaton, some 600 bytes a word.

Null texts have no words; texts without words or runs have no row in `runs` and empty or unchanged texts otherwise. Rows are
independent: repeated rows get equal results, an empty table an empty result; no column but those named is looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillwatch.llm.common import WORD

#: Fewest words of a run, and fewest repeats of its period.
LEAST_WORDS, LEAST_REPEATS = 6, 4
_words = re.compile(WORD).findall

Run = tuple[int, int, int]


class LastEnds:
    """A suffix automaton that knows, for every string read, where it ended last.

    State 0 stands for none, state 1 for the empty string. `left`, `right`, `up` are the splay trees of preferred paths,
    ordered by depth; `up` of a tree's root is the state above the path. `ended`, the place where the strings of a path
    ended last, stands at its tree's root.
    """

    def __init__(self) -> None:
        self.length, self.link, self.after = [0, 0], [0, 0], [{}, {}]
        self.left, self.right, self.up, self.ended = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.last, self.read = 1, 0

    def _state(self, length: int, link: int, after: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.after.append(after)
        for own in (self.left, self.right, self.up):
            own.append(0)
        self.ended.append(-1)
        return len(self.length) - 1

    def append(self, word: int) -> list[tuple[int, int, int]]:
        """Read a word; the segments of its path, longest strings first: (shortest excluded, longest, ended last)."""
        after, length, link = self.after, self.length, self.link
        own = self._state(length[self.last] + 1, 0, {})
        at = self.last
        while at and word not in after[at]:
            after[at][word] = own
            at = link[at]
        if not at:
            above = 1
        else:
            above = after[at][word]
            if length[above] != length[at] + 1:
                above = self._split(above, at, word)
        link[own] = self.up[own] = above
        self.last = own
        segments = self._access(own, self.read)
        self.read += 1
        return segments

    def _split(self, state: int, at: int, word: int) -> int:
        """A state of its own for the shorter strings of `state`, between it and the state it links to."""
        after, link = self.after, self.link
        upper = self._state(self.length[at] + 1, link[state], dict(after[state]))
        while at and after[at].get(word) == state:
            after[at][word] = upper
            at = link[at]
        link[state] = upper
        # It ended where `state` did, so it stands on the same path, right above it.
        self._splay(state)
        above = self.left[state]
        self.left[upper], self.left[state], self.up[upper] = above, upper, state
        if above:
            self.up[above] = upper
        return upper

    def _access(self, state: int, place: int) -> list[tuple[int, int, int]]:
        left, right, up, ended, length = self.left, self.right, self.up, self.ended, self.length
        segments, below = [], 0
        while state:
            self._splay(state)
            if lower := right[state]:
                ended[lower] = ended[state]
            above = up[state]
            if ended[state] >= 0 and length[state]:
                segments.append((length[above] if above else 0, length[state], ended[state]))
            right[state] = below
            if below:
                up[below] = state
            below, state = state, above
        ended[below] = place
        return segments

    def _splay(self, state: int) -> None:
        """Make `state` the root of its path's tree."""
        left, right, up = self.left, self.right, self.up
        while True:
            mid = up[state]
            if not mid or (left[mid] != state and right[mid] != state):
                return
            top = up[mid]
            if top and (left[top] == mid or right[top] == mid):
                self._rotate(mid if (left[mid] == state) == (left[top] == mid) else state)
            self._rotate(state)

    def _rotate(self, state: int) -> None:
        left, right, up = self.left, self.right, self.up
        mid = up[state]
        top = up[mid]
        if left[mid] == state:
            inner = left[mid] = right[state]
            right[state] = mid
        else:
            inner = right[mid] = left[state]
            left[state] = mid
        if inner:
            up[inner] = mid
        up[mid], up[state] = state, top
        if top and left[top] == mid:
            left[top] = state
        elif top and right[top] == mid:
            right[top] = state
        else:
            self.ended[state] = self.ended[mid]


def squares(words: list[int]) -> Iterator[tuple[int, int]]:
    """(end, period) of every square whose half is no repetition itself, by its end."""
    ends = LastEnds()
    for end, word in enumerate(words):
        for shortest, longest, before in ends.append(word):
            if shortest < end - before <= longest:
                yield end, end - before


def all_runs(words: list[int]) -> list[Run]:
    """(start, length, period) of every maximal stretch that holds its smallest period at least twice."""
    found, last = [], {}
    for end, period in squares(words):
        if last.get(period, -1) >= end:
            continue
        start, stop = end - 2 * period + 1, end + 1
        while start and words[start - 1] == words[start - 1 + period]:
            start -= 1
        while stop < len(words) and words[stop] == words[stop - period]:
            stop += 1
        last[period] = stop - 1
        found.append((start, stop - start, period))
    return found


def _stretches(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _counts(values: np.ndarray) -> np.ndarray:
    _, which, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[which]


def stretches(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs can be: each word at least four times, each row of three words at least three times in its stretch."""
    todo, kinds = [(0, len(ids))], int(ids.max(initial=0)) + 1
    while todo:
        start, stop = todo.pop()
        if stop - start < LEAST_WORDS:
            continue
        own = ids[start:stop].astype(np.int64)
        within = _counts(own) >= LEAST_REPEATS
        if within.all():
            # Pairs are numbered anew before the third word joins them, so that no number outgrows 64 bits.
            pairs = np.unique(own[:-1] * kinds + own[1:], return_inverse=True)[1]
            often = _counts(pairs[:-1] * kinds + own[2:]) >= LEAST_REPEATS - 1
            if often.all():
                yield start, stop
                continue
            # Rows next to each other share words, so stretches of rows may overlap by a word or two.
            todo += [(start + a, start + b + 2) for a, b in _stretches(often)]
        else:
            todo += [(start + a, start + b) for a, b in _stretches(within)]


def find_runs(words: list[str]) -> list[Run]:
    """(start, length, period) of the runs of a text, by start and period."""
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int32, len(words))
    found = set()
    for start, stop in stretches(ids):
        for first, length, period in all_runs(ids[start:stop].tolist()):
            if length >= max(LEAST_WORDS, LEAST_REPEATS * period):
                found.add((start + first, length, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(words: list[str], found: list[Run]) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[at] for at in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def densest(found: list[Run]) -> Run | None:
    """The run with the greatest length by period, the first of equals, by start and then period."""
    best = None
    for own in found:
        if best is None or own[1] * best[2] > best[1] * own[2]:
            best = own
    return best


def repeat_tail(words: list[str], seed: int) -> list[str]:
    """Words that repeat from some word on, both set by `seed`; for planting runs."""
    if not words:
        return words
    first = seed % len(words)
    period = 1 + (len(words) - first) // (3 + seed % 8)
    return words[:first] + [words[first + at % period] for at in range(len(words) - first)]


def _mapped(docs: DataFrame, added: str, each: Callable[[list[str]], list[tuple]], tail: Column | None) -> DataFrame:
    """doc_id and the columns `added`, a row for each that `each` makes of a document's words.

    Where `tail` is not null, words are repeated by it before they are looked at.
    """
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(added)])
    arrow = to_arrow_schema(schema)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, rows = [], []
            for at, (text, seed) in enumerate(zip(batch.column("text"), batch.column("_tail"))):
                words = _words(text.as_py() or "")
                if seed.is_valid:
                    words = repeat_tail(words, seed.as_py())
                made = each(words)
                rows += made
                places += [at] * len(made)
            columns = list(zip(*rows)) or [()] * (len(arrow) - 1)
            ids = batch.column("doc_id").take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns, arrow.types[1:])], schema=arrow)

    seeds = F.lit(None).cast("long") if tail is None else tail.cast("long")
    return docs.select("doc_id", "text", seeds.alias("_tail")).mapInArrow(mapped, schema)


def runs(docs: DataFrame, tail: Column | None = None) -> DataFrame:
    """A row per run: doc_id, start (word number from 0), length, period."""
    return _mapped(docs, "start long, length long, period long", find_runs, tail)


def collapse(docs: DataFrame, tail: Column | None = None) -> DataFrame:
    """Per document: doc_id, text with each run cut to its first period, words one blank apart."""
    return _mapped(docs, "text string", lambda words: [(" ".join(kept_words(words, find_runs(words))),)], tail)


def report(docs: DataFrame, tail: Column | None = None) -> DataFrame:
    """Per document: doc_id, number of runs, the run with the greatest exponent, digests of the runs and of the collapsed text."""
    def measured(words: list[str]) -> list[tuple]:
        found = find_runs(words)
        best = densest(found)
        listed = "".join([f"{start},{length},{period}\n" for start, length, period in found])
        text = " ".join(kept_words(words, found))
        return [(
            len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(),
        )]

    return _mapped(
        docs, "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string",
        measured, tail)
