"""Alignment of two tokenizers: which tokens of a byte-level vocabulary (A) and of a vocabulary of pieces (B) overlap.

A encodes a blank and the text, B the text, before which it puts the blank itself; special tokens' strings inside texts are
plain text. So both rows of tokens spell the same bytes. Per batch, `pandas.merge_asof`, keyed by document, finds for each
token's start the token of the other side that covers it, in both directions; together these are all overlapping pairs.
Where tokens of both sides end together, a group ends.

How often a pair of ids is linked is counted over the corpus, by documents that hold it. Documents are dealt with in blocks:
a block's pairs are counted in its task, so that only a block's different pairs travel, not each document's; the counts
come back to the block's own dictionary of pairs, and its documents look their links up there. A block closes when its
documents' different pairs reach `BLOCK`; a single document's different pairs are the least it holds.

Long texts are cut into parts of some `PART` letters, before a single blank between two words, where both vocabularies
end a token whatever follows; only a text without any such place is encoded whole.

A text that is null or empty, or that one of the vocabularies does not spell as it is (U+2581 is a blank to B), has no tokens:
zeros, and an empty string for the groups. Rows are independent up to the counts, where a repeated row counts as a document
of its own. An empty table gives an empty result; no column but doc_id and text is looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillwatch.llm.common import stored

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Letters of a text that are encoded at a time, to the next place to cut.
PART = 1 << 17
#: Letters that are aligned at a time, to the end of their text or part.
ALIGNED = 1 << 20
#: Documents' different pairs in a block, up to the last document's own.
BLOCK = 1 << 21
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: The pattern that byte-level vocabularies of this kind split texts by: a fixed value.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_COMMA, _BAR, _SEMICOLON = range(3)


class Vocabularies:
    """Both tokenizers, with the bytes of each token by id.

    A's merges in the order of its ids are what tiktoken merges by, five times as fast as the file's own library, which splits
    texts by the same pattern. Its pattern has no room for very long texts without a place to cut, which that library takes.
    """

    def __init__(self, a_path: str, b_path: str):
        # Tasks run beside each other already; the library's own threads would take their cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.whole, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.whole.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = _byte_of_letter()
        ranks = {bytes(letters[own] for own in token): at for token, at in model["vocab"].items() if letters.keys() >= set(token)}
        merged = [model["vocab"][left + right] for left, right in (own if isinstance(own, list) else own.split(" ") for own in model["merges"])]
        if merged != sorted(merged):
            raise ValueError(f"{a_path} does not number its tokens in the order of their merges")
        special = {own["content"] for own in json.loads(self.whole.to_str())["added_tokens"]}
        ranks = {token: at for token, at in ranks.items() if self.whole.id_to_token(at) not in special}
        self.a = Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * self.whole.get_vocab_size()
        for token, at in ranks.items():
            self.a_bytes[at] = token
        self.b_bytes = [self._piece_bytes(at) for at in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(own) for own in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(own) for own in self.b_bytes], np.int64)
        self.kinds = max(len(self.a_bytes), len(self.b_bytes))
        #: An id and what follows it, by `follows * kinds + id`.
        self.written = np.array([f"{at}{mark}" for mark in ",|;" for at in range(self.kinds)], object)

    def _piece_bytes(self, at: int) -> bytes:
        if self.b.is_control(at) or self.b.is_unknown(at):
            return b""
        piece = self.b.id_to_piece(at)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(at) else piece.replace("▁", " ").encode()

    def encode(self, parts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """A's and B's ids of parts that start with a blank; None where they do not spell the same bytes."""
        a = [
            self.a.encode_ordinary(part) if len(part) < 2 * PART else self.whole.encode(part, add_special_tokens=False).ids
            for part in parts]
        b = self.b.encode([part[1:] for part in parts], num_threads=1)
        found = []
        for part, a_ids, b_ids in zip(parts, a, b):
            raw = part.encode()
            same = b"".join([self.a_bytes[own] for own in a_ids]) == raw == b"".join([self.b_bytes[own] for own in b_ids])
            found.append((a_ids, b_ids) if same else None)
        return found


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 for itself, others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {chr(byte if byte in printable else next(others)): byte for byte in range(256)}


@lru_cache(1)
def _vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def _loaded(folder: str | None) -> Vocabularies:
    """The vocabularies as the worker finds them, once per worker."""
    if folder:
        return _vocabularies(f"{folder}/{A_FILE}", f"{folder}/{B_FILE}")
    import public_tokenizers

    return _vocabularies(public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE))


def parts_of(text: str) -> Iterator[str]:
    """A blank and the text, in parts that start with a blank each."""
    at, first = 0, " "
    while at < len(text):
        cut = _CUT.search(text, at + PART)
        stop = cut.start() if cut else len(text)
        yield first + text[at:stop]
        at, first = stop, ""


class Aligned:
    """The alignment of a few parts: tokens of both sides with their part and group, links as positions in both."""

    def __init__(self, words: Vocabularies, encoded: list[tuple[list[int], list[int]]]):
        self.words, self.parts = words, len(encoded)
        self.a_ids = np.concatenate([np.asarray(own[0], np.int64) for own in encoded])
        self.b_ids = np.concatenate([np.asarray(own[1], np.int64) for own in encoded])
        self.a_part = np.repeat(np.arange(self.parts), [len(own[0]) for own in encoded])
        self.b_part = np.repeat(np.arange(self.parts), [len(own[1]) for own in encoded])
        # Parts lie one after the other, so ends are places in all of them together.
        a_ends, b_ends = np.cumsum(words.a_sizes[self.a_ids]), np.cumsum(words.b_sizes[self.b_ids])
        self.ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(self.ends, a_ends), np.searchsorted(self.ends, b_ends)
        a_starts, b_starts = a_ends - words.a_sizes[self.a_ids], b_ends - words.b_sizes[self.b_ids]
        a = pd.DataFrame({"part": self.a_part, "start": a_starts, "a": np.arange(len(a_ends))})
        b = pd.DataFrame({"part": self.b_part, "start": b_starts, "b": np.arange(len(b_ends))})
        covering_b = pd.merge_asof(a, b, on="start", by="part")
        covering_a = pd.merge_asof(b, a, on="start", by="part")
        # Tokens that start together are found from both sides.
        covering_a = covering_a[a_starts[covering_a["a"].to_numpy()] != b_starts]
        self.link_a = np.concatenate([covering_b["a"].to_numpy(), covering_a["a"].to_numpy()])
        self.link_b = np.concatenate([covering_b["b"].to_numpy(), covering_a["b"].to_numpy()])

    def bounds(self, part_of: np.ndarray) -> np.ndarray:
        return np.searchsorted(part_of, np.arange(self.parts + 1))

    def groups_per_part(self) -> np.ndarray:
        """Groups of each part: the last token of a part ends its last group."""
        last = np.searchsorted(self.a_part, np.arange(self.parts), side="right") - 1
        return np.diff(np.concatenate(([0], self.a_group[last] + 1)))

    def written(self) -> list[str]:
        """The groups of each part, `a1,a2|b1;a3|b2,b3`."""
        place = np.concatenate([2 * self.a_group, 2 * self.b_group + 1])
        order = np.argsort(place, kind="stable")
        ids, place = np.concatenate([self.a_ids, self.b_ids])[order], place[order]
        follows = np.full(len(place), _SEMICOLON)
        follows[:-1] = np.where(place[1:] == place[:-1], _COMMA, np.where(place[:-1] % 2 == 0, _BAR, _SEMICOLON))
        texts = self.words.written[follows * self.words.kinds + ids]
        stops = np.cumsum(np.bincount(self.a_part, minlength=self.parts) + np.bincount(self.b_part, minlength=self.parts))
        return ["".join(own)[:-1] for own in np.split(texts, stops[:-1])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Part, pair (A's id in the upper half, B's in the lower) and number of links, of each part's different pairs."""
        sizes = len(self.words.a_bytes), len(self.words.b_bytes)
        keys = (self.a_part[self.link_a] * sizes[0] + self.a_ids[self.link_a]) * sizes[1] + self.b_ids[self.link_b]
        keys, times = np.unique(keys, return_counts=True)
        keys, b_id = np.divmod(keys, sizes[1])
        part, a_id = np.divmod(keys, sizes[0])
        return part, a_id << 32 | b_id, times


class _Document:
    """What has been found of a document so far."""

    def __init__(self, row: int):
        self.row, self.spelled, self.n = row, True, np.zeros(4, np.int64)
        self.digest, self.pairs, self.times = hashlib.sha256(), [], []

    def add(self, counts: np.ndarray, written: str, pair: np.ndarray, times: np.ndarray) -> None:
        self.digest.update((";" if self.n[2] else "").encode() + written.encode())
        self.n += counts
        self.pairs.append(pair)
        self.times.append(times)
        if len(self.pairs) > 16:
            self.pairs, self.times = map(lambda own: [own], self.links())

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Different pairs in their order, and how often each is linked."""
        if len(self.pairs) == 1:
            return self.pairs[0], self.times[0]
        pairs, which = np.unique(np.concatenate([*self.pairs, np.zeros(0, np.int64)]), return_inverse=True)
        return pairs, np.bincount(which, np.concatenate([*self.times, np.zeros(0, np.int64)]), len(pairs)).astype(np.int64)


def _steps(texts: pa.Array) -> Iterator[list[tuple[int, str, bool]]]:
    """(row, part, whether it is the row's last) of the texts with letters, a bounded number of letters at a time."""
    step, letters = [], 0
    for row, text in enumerate(texts):
        text = text.as_py()
        if not text:
            continue
        held = None
        for part in parts_of(text):
            if held is not None:
                step.append((row, held, False))
                letters += len(held)
                if letters >= ALIGNED:
                    yield step
                    step, letters = [], 0
            held = part
        step.append((row, held, True))
        letters += len(held)
        if letters >= ALIGNED:
            yield step
            step, letters = [], 0
    if step:
        yield step


def _documents(words: Vocabularies, texts: pa.Array) -> Iterator[_Document]:
    """The documents with tokens, by row."""
    open_document = None
    for step in _steps(texts):
        encoded = words.encode([part for _, part, _ in step])
        spelled = [own for own in encoded if own is not None]
        if spelled:
            aligned = Aligned(words, spelled)
            written = aligned.written()
            a, b = aligned.bounds(aligned.a_part), aligned.bounds(aligned.b_part)
            links = np.bincount(aligned.a_part[aligned.link_a], minlength=aligned.parts)
            counts = np.stack([np.diff(a), np.diff(b), aligned.groups_per_part(), links], axis=1)
            part, pair, times = aligned.pairs()
            stops = np.searchsorted(part, np.arange(aligned.parts + 1)).tolist()
        at = 0
        for (row, _, last), own in zip(step, encoded):
            if open_document is None or open_document.row != row:
                open_document = _Document(row)
            if own is None:
                open_document.spelled = False
            else:
                open_document.add(counts[at], written[at], pair[stops[at]:stops[at + 1]], times[stops[at]:stops[at + 1]])
                at += 1
            if last and open_document.spelled:
                yield open_document


_MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_BLOCK_DDL = f"{_MEASURES}, block long, entries binary, times binary, pairs array<long>, docs array<long>"


def blocks(docs: DataFrame, folder: str | None = None, most: int = BLOCK) -> DataFrame:
    """Per document its measures and its links, and after the documents of each block a row with the block's pairs.

    `entries` and `times` are a document's different pairs, as places in its block's `pairs`, and how often each is linked, as
    little-endian unsigned 32-bit integers; `docs` is how many documents of the block hold each pair. Blocks are numbered by task,
    so the rows have to be stored before they are read twice.
    """
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(_BLOCK_DDL)])
    arrow = to_arrow_schema(schema)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _loaded(folder)
        block = TaskContext.get().partitionId() << 32
        ids, rows, held, size = [], [], [], 0

        def closed() -> pa.RecordBatch:
            pairs, place, n = np.unique(
                np.concatenate([*(own for own, _ in held), np.zeros(0, np.int64)]), return_inverse=True, return_counts=True)
            place, at, columns = place.astype("<u4"), 0, []
            for measures, (own, times) in zip(rows, held):
                entries = place[at:at + len(own)].tobytes()
                at += len(own)
                columns.append((*measures, block, entries, times.astype("<u4").tobytes(), None, None))
            columns.append((*[None] * 5, block, None, None, pairs, n))
            return pa.RecordBatch.from_arrays(
                [pa.chunked_array([*ids, pa.nulls(1, arrow.field(0).type)]).combine_chunks(),
                 *(pa.array(own, field.type) for own, field in zip(zip(*columns), list(arrow)[1:]))], schema=arrow)

        def kept(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nonlocal block, size
            start = 0

            def nothing(upto: int) -> None:
                rows.extend([(0, 0, 0, 0, "")] * upto)
                held.extend([(np.zeros(0, np.int64),) * 2] * upto)

            done = 0
            for own in _documents(words, batch.column("text")):
                nothing(own.row - done)
                pairs, times = own.links()
                rows.append((*own.n.tolist(), own.digest.hexdigest()))
                held.append((pairs, times))
                size += len(pairs)
                done = own.row + 1
                if size >= most:
                    ids.append(batch.column("doc_id").slice(start, done - start))
                    yield closed()
                    start, size, block = done, 0, block + 1
                    ids.clear(), rows.clear(), held.clear()
            nothing(batch.num_rows - done)
            ids.append(batch.column("doc_id").slice(start))

        for batch in batches:
            yield from kept(batch)
        if rows:
            yield closed()

    return docs.select("doc_id", "text").mapInArrow(mapped, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """Per linked pair of ids in `blocks`: `pair`, how many documents hold it, whether no pair of its A id is in more."""
    pairs = found.where(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n"))
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    found = counts.join(most, F.shiftright("pair", 32) == F.col("a"))
    return found.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def report(docs: DataFrame, folder: str | None = None, most: int = BLOCK) -> DataFrame:
    """Per document: doc_id, tokens of A and B, groups, links, links of a best count, sum of counts over links, groups' digest.

    `folder` is where tasks find the vocabulary files, by default where the package of vocabularies has them; `most` is the
    number of documents' different pairs at which a block closes.
    """
    found = stored(blocks(docs, folder, most), "alignment")
    counts = pair_counts(found)
    places = found.where(F.col("pairs").isNotNull()).select(
        F.col("block").alias("in_block"), F.posexplode("pairs").alias("place", "own_pair"))
    known = places.join(counts, F.col("own_pair") == F.col("pair")).select("in_block", "place", "n", "best")
    measured = found.where(F.col("pairs").isNull()).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "block", "entries", "times")
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(f"{_MEASURES}, n_best long, count_sum long")])
    arrow = to_arrow_schema(schema)

    def summed(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        counts, best = np.zeros(pairs.num_rows, np.int64), np.zeros(pairs.num_rows, np.int64)
        place = pairs["place"].to_numpy()
        counts[place], best[place] = pairs["n"].to_numpy(), pairs["best"].to_numpy()
        sums = []
        for entries, times in zip(documents["entries"], documents["times"]):
            own, times = np.frombuffer(entries.as_py(), "<u4"), np.frombuffer(times.as_py(), "<u4").astype(np.int64)
            sums.append((int(times @ best[own]), int(times @ counts[own])))
        columns = zip(*sums) if sums else ((), ())
        return pa.Table.from_arrays(
            [*(documents[name] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")),
             *(pa.array(own, pa.int64()) for own in columns)], schema=arrow)

    return measured.groupBy("block").cogroup(known.groupBy("in_block")).applyInArrow(summed, schema)


def groups(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Per group: doc_id, its number from 0, the ids of A's and of B's tokens in it, in their order."""
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL("number long, a_ids array<int>, b_ids array<int>")])
    arrow = to_arrow_schema(schema)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _loaded(folder)
        for batch in batches:
            for row, text in enumerate(batch.column("text")):
                encoded = words.encode(list(parts_of(text.as_py() or "")))
                if not encoded or None in encoded:
                    continue
                own = Aligned(words, encoded)
                number = len(own.ends)
                offsets = [np.searchsorted(side, np.arange(number + 1)) for side in (own.a_group, own.b_group)]
                lists = [
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                    for at, ids in zip(offsets, (own.a_ids, own.b_ids))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array([row] * number, pa.int64())), pa.array(range(number), pa.int64()), *lists],
                    schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(mapped, schema)
