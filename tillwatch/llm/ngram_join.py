"""N-gram Jaccard join: which documents share at least `percent` of their word n-grams, and the groups they form.

Documents with the same set of n-grams form a class; what follows joins classes, so copies are never paired.

1. A sketch of fixed size counts n-grams over all documents. It orders each class's n-grams, rare first.
2. Two sets as alike as asked for share one of their first n - ceil(percent * n) + 1 n-grams, so only this prefix is
   indexed: (n-gram, class) entries travel packed, and those classes that meet in an n-gram form a block. Blocks with the
   same members count once.
3. Classes that share blocks are dealt to chunks of bounded expected size, and each pair of chunks that meets in a block
   is a unit of work, with just the members of these blocks. A very large block is so cut into many units, and no task
   ever holds it as a whole. The length filter and the suffix filter, which bounds what two sets can have in common by
   their counts per hash class, drop members that can be like no other in the unit.
4. Only then are the n-grams themselves sent to the units. Prefixes are joined, length and positional filters drop pairs,
   and each pair that is left is verified once by counting common n-grams. Of the links found, a unit hands on a spanning
   forest, which joins the same documents with as many rows as members instead of as many as pairs.
5. Connected components over these links give each document the smallest id reachable.

Words are split at ASCII blanks with A to Z lower-cased. A text with fewer words than n is one n-gram; a null or empty text
has none and is linked with nothing. n-grams are compared by 64-bit hashes, sets by 128-bit hashes. Documents without an
id link with nothing and have a null component. Rows that repeat an id are told apart by their texts: each has the
component of its own text's class. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import stored

NGRAM = 5
PERCENT = 80
#: The sketch has 2^SKETCH_BITS counters, whatever the input's size; it is what is broadcast.
SKETCH_BITS = 20
SKETCH_PARTS = 64
#: Index entries that one bucket of the prefix index holds, about.
BUCKET_ENTRIES = 1_000_000
#: An n-gram that so many documents beyond the mean counter share is hot: its entries are dealt out by class.
HOT = 1_000_000
#: Classes in a chunk, about.
CHUNK = 256
#: Bits of the bitmap that marks which documents' n-grams are needed once more.
BITMAP_BITS = 23
#: Bytes of a text whose words are hashed at a time, to the end of a word.
PIECE_BYTES = 1 << 18
_BLANK = re.compile(rb"[ \t-\r]")
#: Pairs that verification expands at a time.
_EXPANDED = 500_000
#: Sets that a task remembers to have indexed.
_REMEMBERED = 1_000_000
_ENTRY = np.dtype([("gram", "<u8"), ("high", "<u8"), ("low", "<u8")])


class Grams:
    """Distinct n-gram hashes of texts, ascending.

    All words of a text are hashed at once: a word's hash is the difference of two running sums of its bytes' numbers times
    powers of a factor, brought to the same power.
    """

    def __init__(self, n: int = NGRAM):
        self.n = n
        number = lambda seed: np.uint64(xxhash.xxh64_intdigest(b"gram", seed) | 1)
        self.factors = [number(seed) for seed in range(n)]
        self.letters = np.array([number(1000 + byte) for byte in range(256)], np.uint64)
        self.blank = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
        factor = int(number(999))
        self.steps = np.array([factor, pow(factor, -1, 1 << 64)], np.uint64)
        self.powers = np.ones((2, 1), np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        hashes = self.words(text or "")
        if len(hashes) >= self.n:
            steps = len(hashes) - self.n + 1
            mixed = hashes[:steps] * self.factors[0]
            for step in range(1, self.n):
                mixed += hashes[step:step + steps] * self.factors[step]
        elif len(hashes):
            mixed = np.array([xxhash.xxh64_intdigest(hashes.tobytes(), len(hashes))], np.uint64)
        else:
            return hashes
        mixed = np.sort(_stirred(mixed))
        return mixed[np.r_[True, mixed[1:] != mixed[:-1]]]

    def words(self, text: str) -> np.ndarray:
        """The words' hashes, taken piece by piece of the text, so that little more than its bytes is held beside them."""
        raw, found, at = text.encode("utf-8").lower(), [], 0
        while at < len(raw):
            cut = _BLANK.search(raw, at + PIECE_BYTES)
            stop = cut.start() if cut else len(raw)
            found.append(self._words_of(np.frombuffer(raw[at:stop] + b" ", np.uint8)))
            at = stop
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def _words_of(self, letters: np.ndarray) -> np.ndarray:
        edges = np.flatnonzero(np.diff(self.blank[letters], prepend=True))
        starts, ends = edges[::2], edges[1::2]
        powers = self.powers
        if len(letters) > powers.shape[1]:
            powers = np.ones((2, max(len(letters), 2 * PIECE_BYTES)), np.uint64)
            powers[:, 1:] = self.steps[:, None]
            powers = np.cumprod(powers, axis=1, dtype=np.uint64)
            if powers.shape[1] == 2 * PIECE_BYTES:
                self.powers = powers
        sums = np.cumsum(np.r_[np.uint64(0), self.letters[letters] * powers[0, :len(letters)]], dtype=np.uint64)
        return _stirred((sums[ends] - sums[starts]) * powers[1, starts])


def _stirred(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return numbers ^ (numbers >> np.uint64(29))


def signature(grams: np.ndarray) -> bytes:
    """How many n-grams fall into each hash class, a byte each (255 for more); about eight n-grams to a class."""
    bits = max(0, len(grams) // 8).bit_length()
    counts = np.bincount((grams & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def set_key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.astype("<u8").tobytes())


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def ranks_of(grams: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    return ranks[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]


def rare_first(grams: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The n-grams by rank, then hash; `ranks` has one byte per counter of the sketch."""
    rank = ranks_of(grams, ranks).astype(np.uint64)
    return grams[np.argsort((rank << np.uint64(56)) | (grams >> np.uint64(8)), kind="stable")]


# Step 1: sets of documents, and the sketch.

def _surveyed(n: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("key", pa.binary()), ("size", pa.int64()), ("signature", pa.binary()), ("part", pa.int32()), ("counts", pa.binary()), ("mark", pa.int64()),
    ])

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of, counts, waiting, held = Grams(n), np.zeros(1 << SKETCH_BITS, np.int64), [], 0

        def count() -> None:
            nonlocal held
            if waiting:
                places = (np.concatenate(waiting) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                np.add(counts, np.bincount(places, minlength=len(counts)), out=counts)
                waiting.clear()
                held = 0

        for batch in batches:
            keys, sizes, signatures = [], [], []
            for text in batch.column("text"):
                grams = grams_of(text.as_py())
                keys.append(set_key(grams) if len(grams) else None)
                sizes.append(len(grams))
                signatures.append(signature(grams))
                waiting.append(grams)
                held += len(grams)
                if held > 1 << SKETCH_BITS:
                    count()
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(signatures, pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()), batch.column("mark")],
                schema=schema)
        count()
        pieces = [(at, piece) for at, piece in enumerate(np.split(counts, SKETCH_PARTS)) if piece.any()]
        if pieces:
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(pieces), schema.field(at).type) for at in range(4)),
                 pa.array([at for at, _ in pieces], pa.int32()),
                 pa.array([zlib.compress(piece.astype("<i8").tobytes(), 1) for _, piece in pieces], pa.binary()),
                 pa.nulls(len(pieces), pa.int64())], schema=schema)

    return survey


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of the same part added up, one batch of them in memory at a time."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
            own = np.frombuffer(zlib.decompress(counts.as_py()), "<i8")
            sums[part] = sums[part] + own if part in sums else own
    if sums:
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(list(sums), pa.int32()), "counts": [own.astype("<i8").tobytes() for own in sums.values()]})


def _rank(counts):
    return np.minimum(255, 8 * np.log2(1.0 + counts)).astype(np.uint8)


def gram_ranks(pieces: DataFrame, hot: int = HOT) -> tuple[np.ndarray, int]:
    """A byte per counter that grows with it, 2^SKETCH_BITS bytes whatever the input; and the rank above which it is hot."""
    counts = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    added = pieces.repartition(SKETCH_PARTS, "part").mapInArrow(_summed, "part int, counts binary")
    for row in added.toLocalIterator():
        counts[row["part"]] = np.frombuffer(row["counts"], "<i8")
    mean = counts.mean()
    return _rank(counts.ravel()), int(_rank(np.array(max(2 * mean, mean + hot))))


# Step 2: the prefix index.

def _indexed(ranks, hot: int, buckets: int, n: int, percent: int):
    def emit(waiting: list[np.ndarray]) -> pa.RecordBatch:
        entries = np.concatenate(waiting)
        dealt = np.where(ranks_of(entries["gram"], ranks.value) > hot, entries["low"], entries["gram"])
        bucket = (dealt % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        entries, bucket = entries[order], bucket[order]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array(bucket[starts]),
            "entries": [own.tobytes() for own in np.split(entries, starts[1:])],
        })

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of, seen, waiting, held = Grams(n), set(), [], 0
        for batch in batches:
            for text in batch.column("text"):
                grams = grams_of(text.as_py())
                key = set_key(grams)
                if not len(grams) or key in seen:
                    continue
                if len(seen) > _REMEMBERED:
                    seen.clear()
                seen.add(key)
                prefix = rare_first(grams, ranks.value)[:prefix_length(len(grams), percent)]
                entries = np.empty(len(prefix), _ENTRY)
                entries["gram"] = prefix
                entries["high"], entries["low"] = np.frombuffer(key, ">u8")
                waiting.append(entries)
                held += len(prefix)
            if held > 1 << 19:
                yield emit(waiting)
                waiting, held = [], 0
        if held:
            yield emit(waiting)

    return index


def _blocks(entries: np.ndarray, ranks: np.ndarray, hot: int) -> pa.RecordBatch | None:
    """(block, key, least key of the block) for n-grams with two classes or more; blocks of equal members once.

    A hot n-gram's entries are dealt over all buckets, so here its block is named by the n-gram, which all of them know.
    """
    entries = np.unique(entries)  # by n-gram, then key
    is_hot = ranks_of(entries["gram"], ranks) > hot
    apart, entries = entries[is_hot], entries[~is_hot]
    blocks, keys, least = [own.tobytes() for own in apart["gram"]], _key_bytes(apart), [own.tobytes() for own in apart["gram"]]
    starts = np.flatnonzero(np.r_[True, entries["gram"][1:] != entries["gram"][:-1]]) if len(entries) else np.zeros(0, int)
    sizes = np.diff(np.r_[starts, len(entries)])
    if (sizes > 1).any():
        entries = entries[np.repeat(sizes > 1, sizes)]
        sizes = sizes[sizes > 1]
        starts = np.cumsum(sizes) - sizes
        spread = (entries["high"] ^ (entries["low"] >> np.uint64(7))) * np.uint64(0xC2B2AE3D27D4EB4F)
        block = np.empty(len(starts), [("a", "<u8"), ("b", "<u8"), ("n", "<i8")])
        block["a"] = np.add.reduceat(entries["low"] * np.uint64(0x9E3779B97F4A7C15), starts)
        block["b"] = np.add.reduceat(spread ^ (spread >> np.uint64(31)), starts)
        block["n"] = sizes
        _, first = np.unique(block, return_index=True)
        chosen = np.zeros(len(starts), bool)
        chosen[first] = True
        every = _key_bytes(entries[np.repeat(chosen, sizes)])
        keys += every
        at = 0
        for own, size in zip(block[chosen], sizes[chosen].tolist()):
            blocks += [own.tobytes()] * size
            least += [every[at]] * size
            at += size
    if not keys:
        return None
    return pa.RecordBatch.from_arrays([pa.array(own, pa.binary()) for own in (blocks, keys, least)], names=["block", "key", "least"])


def _key_bytes(entries: np.ndarray) -> list[bytes]:
    both = np.empty((len(entries), 2), ">u8")
    both[:, 0], both[:, 1] = entries["high"], entries["low"]
    return [own.tobytes() for own in both]


def _joined_prefixes(ranks, hot: int):
    """Blocks of each bucket; rows come by bucket."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, waiting = None, []
        for batch in batches:
            for found, entries in zip(batch.column("bucket").to_pylist(), batch.column("entries")):
                if found != bucket:
                    if waiting and (blocks := _blocks(np.concatenate(waiting), ranks.value, hot)):
                        yield blocks
                    bucket, waiting = found, []
                waiting.append(np.frombuffer(entries.as_py(), _ENTRY))
        if waiting and (blocks := _blocks(np.concatenate(waiting), ranks.value, hot)):
            yield blocks

    return join


# Step 4: units of work.

def _expanded(groups: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i < j, of all pairs inside runs of `groups`; a bounded number of pairs at a time."""
    starts = np.cumsum(sizes) - sizes
    at = 0
    while at < len(sizes):
        until = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:] * sizes[at:]), _EXPANDED, "right")))
        own, first = sizes[at:until], starts[at:until]
        left = np.repeat(np.arange(first[0], first[0] + own.sum()), np.repeat(own, own))
        # Each member is paired with every member of its run, then the upper half is kept.
        offset = np.arange(len(left)) - np.repeat(np.cumsum(np.repeat(own, own)) - np.repeat(own, own), np.repeat(own, own))
        right = np.repeat(np.repeat(first, own), np.repeat(own, own)) + offset
        upper = left < right
        yield left[upper], right[upper]
        at = until


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal values together, without those that stand alone, and the runs' sizes."""
    order = np.argsort(values, kind="stable")
    own = values[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    sizes = np.diff(np.r_[starts, len(own)])
    return order[np.repeat(sizes > 1, sizes)], sizes[sizes > 1]


def linked_pairs(sets: list[np.ndarray], across: np.ndarray | None = None, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of `sets` (n-grams, rare first) that are alike enough; only between sides where `across` has them."""
    m = len(sets)
    sizes = np.array([len(own) for own in sets], np.int64)
    owner = np.repeat(np.arange(m), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    in_prefix = np.flatnonzero(place < np.repeat([prefix_length(int(n), percent) for n in sizes], sizes))
    # Prefix join, with the count of common n-grams so far and the place of the last of them.
    shared = np.zeros(m * m, np.int64)
    last = np.zeros((2, m * m), np.int64)
    order, runs = _runs(grams[in_prefix])
    order = in_prefix[order]
    for left, right in _expanded(order, runs):
        i, j = order[left], order[right]
        pair = owner[i] * m + owner[j]
        shared += np.bincount(pair, minlength=m * m)
        np.maximum.at(last[0], pair, place[i])
        np.maximum.at(last[1], pair, place[j])
    pairs = np.flatnonzero(shared)
    i, j = pairs // m, pairs % m
    if across is not None:
        keep = across[i] != across[j]
        i, j, pairs = i[keep], j[keep], pairs[keep]
    need = -(-percent * (sizes[i] + sizes[j]) // (100 + percent))
    # Length filter.
    keep = np.minimum(sizes[i], sizes[j]) >= need
    # Positional filter: what can still be common after the last common n-gram of both prefixes. n-grams that only one
    # side's prefix covers may lie on either side of it, so the bound adds those before it.
    x, y = last[0][pairs], last[1][pairs]
    keep &= np.minimum(x, y) + 1 + np.minimum(sizes[i] - x - 1, sizes[j] - y - 1) >= need
    i, j, need = i[keep], j[keep], need[keep]
    if not len(i):
        return i, j
    # Verification of what is left, all pairs at once.
    asked = np.zeros(m, bool)
    asked[i] = asked[j] = True
    rows = np.flatnonzero(asked[owner])
    order, runs = _runs(grams[rows])
    order = rows[order]
    common = np.zeros(m * m, np.int64)
    for left, right in _expanded(order, runs):
        common += np.bincount(owner[order[left]] * m + owner[order[right]], minlength=m * m)
    both = common[i * m + j]
    alike = 100 * both >= percent * (sizes[i] + sizes[j] - both)
    return i[alike], j[alike]


def spanning(ids: list[int], i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """(smallest id of its tree, id) for the linked ones."""
    parent = list(range(len(ids)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        a, b = root(a), root(b)
        if a != b:
            if ids[b] < ids[a]:
                a, b = b, a
            parent[b] = a
    return [(ids[root(x)], ids[x]) for x in range(len(ids)) if root(x) != x]


def _possible(sizes: np.ndarray, signatures: list[bytes], across: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that the length filter and the suffix filter leave.

    The suffix filter: two sets have no more in common than the smaller count of each hash class. Signatures of different
    widths are folded to the smaller; a class with 255 n-grams or more is taken to have any number in common.
    """
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    width = np.array([len(signatures[at]) for at in order])  # grows with the size
    found = []
    for narrow in np.unique(width):
        first, until = np.searchsorted(width, narrow), np.searchsorted(width, 2 * narrow, "right")
        table = np.stack([_folded(signatures[at], narrow) for at in order[first:until]])
        for row in range(first, np.searchsorted(width, narrow, "right")):
            end = min(until, np.searchsorted(sizes, sizes[row] * 100 // percent, "right"))
            others = np.arange(row + 1, end)
            if across is not None:
                others = others[across[order[others]] != across[order[row]]]
            need = -(-percent * (sizes[row] + sizes[others]) // (100 + percent))
            common = np.minimum(table[row - first], table[others - first]).sum(1, dtype=np.int64)
            good = others[common >= need]
            found.append(np.stack([np.full(len(good), order[row]), order[good]]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return pairs[0], pairs[1]


def _folded(own: bytes, width: int) -> np.ndarray:
    counts = np.frombuffer(own, np.uint8).astype(np.uint16)
    counts[counts == 255] = 1 << 14
    return counts.reshape(-1, width).sum(0, dtype=np.uint16)


def _units(make, columns: tuple[str, ...]):
    """What `make` finds in each unit; the rows of a unit come together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, waiting = None, []
        for batch in batches:
            for found, *row in zip(*(batch.column(name).to_pylist() for name in ("unit", *columns))):
                if found != unit:
                    if len(waiting) > 1:
                        yield make(unit, waiting)
                    unit, waiting = found, []
                waiting.append(row)
        if len(waiting) > 1:
            yield make(unit, waiting)

    return work


def _sides(rows: list) -> np.ndarray | None:
    sides = np.array([own[-1] for own in rows])
    return sides if (sides != sides[0]).any() else None


def _sifted(percent: int):
    """The members of a unit that may be alike with another by length and signature."""

    def sift(unit: int, rows: list) -> pa.RecordBatch:
        pairs = _possible(np.array([own[1] for own in rows]), [own[2] for own in rows], _sides(rows), percent)
        left = np.unique(np.concatenate(pairs)).tolist()
        return pa.RecordBatch.from_arrays([
            pa.array([unit] * len(left), pa.int64()), pa.array([rows[at][0] for at in left], pa.binary()),
            pa.array([rows[at][-1] for at in left], pa.int32()),
        ], names=["unit", "key", "side"])

    return _units(sift, ("key", "size", "signature", "side"))


def _worked(percent: int):
    """Links found in units."""

    def links(unit: int, rows: list) -> pa.RecordBatch:
        ids = [own[0] for own in rows]
        found = spanning(ids, *linked_pairs([np.frombuffer(own[1], "<u8") for own in rows], _sides(rows), percent))
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return _units(links, ("class_id", "grams", "side"))


def _wanted(ranks, bitmap, n: int):
    """key and n-grams, rare first, of documents that the bitmap marks."""
    schema = pa.schema([("key", pa.binary()), ("grams", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of = Grams(n)
        for batch in batches:
            mark = batch.column("mark").to_numpy()
            marked = (bitmap.value[mark >> 3] >> (mark & 7)) & 1
            found = [grams_of(batch.column("text")[int(at)].as_py()) for at in np.flatnonzero(marked)]
            found = [own for own in found if len(own)]
            yield pa.RecordBatch.from_arrays([
                pa.array([set_key(own) for own in found], pa.binary()),
                pa.array([rare_first(own, ranks.value).astype("<u8").tobytes() for own in found], pa.binary()),
            ], schema=schema)

    return sets


def _marked(ids: DataFrame) -> np.ndarray:
    """A bitmap of 2^BITMAP_BITS bits, whatever the number of ids: those at an id's hash are set."""
    # Bits and buckets of Spark's bitmaps count from number 1 on.
    mark = ids.select((F.pmod(F.xxhash64("first_id"), F.lit(1 << BITMAP_BITS)) + 1).alias("mark"))
    blocks = mark.groupBy(F.bitmap_bucket_number("mark").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("mark")).alias("bits"))
    whole = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for row in blocks.collect():
        at = (row["bucket"] - 1) * 4096
        whole[at:at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return whole


# Step 5: components.

def components(links: DataFrame) -> DataFrame:
    """id and component, the smallest id it is linked to by any number of links, for each id in `links` (a, b).

    Each id hooks on to its smallest neighbour and takes over where that one leads until nothing changes; links between
    different groups are carried over to the groups' ids and the same starts anew, at most as often as the number of
    links can be halved. Each table is stored, so the work never starts over, and joins can be split where an id is hot.
    """
    links = stored(links.distinct(), "links")
    found = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a")).toDF("id", "other")
        leads = stored(
            both.groupBy("id").agg(F.min("other").alias("to")).select("id", F.least("id", "to").alias("to")), "leads")
        while True:
            further = stored(
                leads.join(leads.select(F.col("id").alias("to"), F.col("to").alias("then")), "to").select(
                    "id", F.col("then").alias("to"), (F.col("then") != F.col("to")).alias("moved")), "leads")
            leads = further.select("id", "to")
            if further.filter("moved").isEmpty():
                break
        there = lambda name: leads.select(F.col("id").alias(name), F.col("to").alias(f"{name}_to"))
        found = leads if found is None else stored(
            found.join(leads.select(F.col("id").alias("to"), F.col("to").alias("then")), "to", "left").select(
                "id", F.coalesce("then", "to").alias("to")), "found")
        links = stored(
            links.join(there("a"), "a").join(there("b"), "b").filter("a_to <> b_to").select(
                F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "links")
    if found is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found.withColumnRenamed("to", "component")


def _mark() -> Column:
    """A number for a row's text, by which rows that share an id are told apart."""
    return F.xxhash64("text").alias("mark")


def _by_text(docs: DataFrame, n: int, percent: int, hot: int) -> DataFrame:
    """`classified`, with the mark of each row's text and the label of its component, null for texts without words."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text", _mark())
    survey = stored(texts.mapInArrow(
        _surveyed(n), "doc_id long, key binary, size long, signature binary, part int, counts binary, mark long"), "surveyed")
    sized = survey.filter("size is not null").select("doc_id", "mark", "key", "size", "signature")
    ranks, hot = gram_ranks(survey.filter("part is not null").select("part", "counts"), hot)
    ranks = spark.sparkContext.broadcast(ranks)
    linkable = sized.filter("key is not null and doc_id is not null")
    named = stored(linkable.groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.max("size").alias("size"), F.max("signature").alias("signature")), "classes")
    # A class goes by its least id, but where an id has several texts, the classes that share it go by their sets.
    shared = named.groupBy("first_id").agg(F.count("*").alias("n")).filter("n > 1")
    classes = stored(named.join(shared, "first_id", "left").withColumn(
        "class_id", F.when(F.col("n").isNull(), F.col("first_id")).otherwise(F.xxhash64("key"))).drop("n"), "named")

    entries = sized.agg(F.sum(F.col("size") * (100 - percent) / 100 + 1)).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, math.ceil(entries / BUCKET_ENTRIES))
    blocks = stored(
        texts.filter("doc_id is not null").mapInArrow(_indexed(ranks, hot, buckets, n, percent), "bucket long, entries binary")
        .repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket")
        .mapInArrow(_joined_prefixes(ranks, hot), "block binary, key binary, least binary").distinct(), "blocks")
    links = _links(texts, blocks, classes, ranks, n, percent)
    groups = components(links)
    known = stored(
        classes.join(groups.withColumnRenamed("id", "class_id"), "class_id", "left").select(
            "key", "first_id", F.coalesce("component", "class_id").alias("label")), "components")
    least = known.groupBy("label").agg(F.min("first_id").alias("component_id"))
    linked = sized.filter("doc_id is not null").join(known.join(least, "label").select("key", "label", "component_id"), "key", "left")
    return linked.select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "mark", "label",
    ).unionByName(sized.filter("doc_id is null").select(
        "doc_id", F.col("size").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), "mark",
        F.lit(None).cast("long").alias("label")))


def classified(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT, hot: int = HOT) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, null for documents that link with nothing by lack of an id.

    Where rows share an id, each row's component is that of its own text.
    """
    return _by_text(docs, n, percent, hot).select("doc_id", "n_shingles", "component_id")


def _links(texts: DataFrame, blocks: DataFrame, classes: DataFrame, ranks, n: int, percent: int) -> DataFrame:
    """A spanning forest per unit of the links between classes, as (a, b) of class ids."""
    spark = texts.sparkSession
    # Classes that meet are dealt to the same chunks as far as the least key of their blocks says.
    labels = stored(blocks.groupBy("key").agg(F.min("least").alias("label")), "labels")
    crowds = stored(labels.groupBy("label").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), "crowds")
    dealt = stored(labels.join(crowds, "label").select(
        "key", F.xxhash64("label", F.pmod(F.xxhash64("key"), "chunks")).alias("chunk")), "chunks")
    # A block's members in one chunk; pairs of chunks that meet in a block.
    shares = stored(blocks.join(dealt, "key").groupBy("block", "chunk").agg(F.collect_list("key").alias("keys")), "shares")
    one, other = (shares.select("block", F.col("chunk").alias(name), F.col("keys").alias(f"{name}_keys")) for name in ("c", "d"))
    met = one.join(other, "block").filter(
        (F.col("c") < F.col("d")) | ((F.col("c") == F.col("d")) & (F.size("c_keys") > 1)))
    unit = F.xxhash64("c", "d").alias("unit")
    members = (
        met.select(unit, "c", F.explode(F.col("c_keys")).alias("key")).withColumn("side", F.lit(0))
        .unionByName(met.filter("c < d").select(unit, "d", F.explode("d_keys").alias("key"))
                     .withColumn("side", F.lit(1)).withColumnRenamed("d", "c"))
        .select("unit", "key", "side").distinct()
    )
    # Signatures are small; only what they leave is worth the n-grams themselves.
    members = stored(
        members.join(classes.select("key", "size", "signature"), "key")
        .repartition("unit").sortWithinPartitions("unit", "key").select("unit", "key", "size", "signature", "side")
        .mapInArrow(_sifted(percent), "unit long, key binary, side int"), "members")
    needed = stored(
        classes.select("key", "class_id", "first_id").join(members.select("key").distinct(), "key", "left_semi"), "needed")
    bitmap = spark.sparkContext.broadcast(_marked(needed))
    sets = (
        texts.filter("doc_id is not null")
        .select("text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITMAP_BITS)).alias("mark"))
        .mapInArrow(_wanted(ranks, bitmap, n), "key binary, grams binary")
        .join(needed.select("key", "class_id"), "key").dropDuplicates(["key"]).select("key", "class_id", "grams")
    )
    work = members.join(stored(sets, "sets"), "key").select("unit", "class_id", "grams", "side")
    return work.repartition("unit").sortWithinPartitions("unit", "class_id").mapInArrow(_worked(percent), "a long, b long")


def without_near_copies(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """One document of each group, the one with the smallest id; those without an id stay. Columns as they were.

    Rows that share an id are told apart by their texts: each belongs to the group of its own text. Of a group's rows with the
    smallest id, the one with the least hash of its text stays, then the one whose other columns come first as JSON; of rows
    without words that share id and text, one stays.
    """
    rows = _by_text(docs, n, percent, HOT).filter("doc_id is not null")
    first = F.min(F.struct("doc_id", "mark")).alias("first")
    kept = rows.filter("label is not null").groupBy("label").agg(first).select("first.*").unionByName(
        rows.filter("label is null").select("doc_id", "mark").distinct())
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    marked = docs.filter("doc_id is not null").withColumns({"_id": F.col("doc_id").cast("long"), "_mark": _mark()})
    found = marked.join(kept, (F.col("_id") == kept["doc_id"]) & (F.col("_mark") == kept["mark"]), "left_semi")
    place = Window.partitionBy("_id", "_mark").orderBy(F.to_json(F.struct(*others)) if others else F.lit(0))
    one = found.withColumn("_place", F.row_number().over(place)).filter("_place = 1")
    return one.select(*docs.columns).unionByName(docs.filter("doc_id is null"))
