"""SentencePiece encoding and decoding with a public merge-type model.

Merges always take the best-scored pair of neighbours, the leftmost of equals. Two facts make the result unique without
merging a whole text: it is the one row of pieces in which each piece and each pair of neighbours, merged again by
themselves, stay as they are, and a text's start has one such row that ends at a given place. So pieces are tried from
the left, the longest first (Aho-Corasick over the reversed letters finds the longest piece from each place on), a pair is
accepted when merging its letters again gives the same two pieces, a shorter piece follows a refused one, and a place from
which nothing led on is marked in a bitfield and never tried again. Letters that no piece holds are spelled in bytes.

No piece goes over from a letter to a blank, or from letters of words to other signs, so a text is cut there and encoded
word by word, and a worker remembers the words it has met lately.
Texts are handled in slices of some `SLICE` letters, cut before blanks: what is held beside the text and its ids does not
grow with it. Only a run of letters without any blank is held whole, at about ten bytes a letter.

Null text counts as empty; an empty text has the end id alone and decodes to an empty text. Rows are independent: repeated
rows get equal results, an empty table an empty result, and no column but the text is looked at.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from tillwatch.llm.common import map_texts

MODEL = "piece_bpe_32k.model"
#: Words, and pairs of pieces, that a worker remembers at a time, so that its memory stays bounded.
REMEMBERED = 300_000
#: Letters of a text that are encoded at a time, to the next place to cut.
SLICE = 1 << 18
BLANK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6

#: Where a text may be cut: before a blank that follows another letter.
_CUT = re.compile(f"(?<=[^ {BLANK}])[ {BLANK}]")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Pieces:
    """Encodes and decodes with the pieces of a model file."""

    def __init__(self, path: str):
        from ahocorasick import Automaton
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = [own.type for own in model.pieces]
        as_it_is = model.normalizer_spec.add_dummy_prefix and not (
            model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces
            or model.trainer_spec.treat_whitespace_as_suffix)
        if model.trainer_spec.model_type != model.trainer_spec.BPE or not as_it_is or set(kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError(f"{path} is no merge-type model of plain pieces that leaves texts as they are")
        self.end = model.trainer_spec.eos_id
        pieces = {own.piece: at for at, own in enumerate(model.pieces) if own.type == _NORMAL}
        if any(BLANK in piece.lstrip(BLANK) or not set(piece) <= pieces.keys() for piece in pieces):
            raise ValueError(f"{path} has pieces over word ends, or of letters that are none")
        self.words = re.compile(self._word_pattern(pieces)).findall
        self.ids, self.pieces = pieces, [own.piece for own in model.pieces]
        self.scores = [own.score for own in model.pieces]
        self.sizes = [len(own.piece) if own.type == _NORMAL else 0 for own in model.pieces]
        #: The longest piece that a piece starts with, -1 for single letters.
        self.shorter = [-1] * len(kinds)
        self.longest = Automaton()
        for piece, own in pieces.items():
            self.longest.add_word(piece[::-1], own)
            self.shorter[own] = next((pieces[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in pieces), -1)
        self.longest.make_automaton()
        self.bytes = {int(own.piece[1:-1], 16): at for at, own in enumerate(model.pieces) if own.type == _BYTE}
        #: What a piece is in a decoded text; control pieces are nothing.
        self.surface = [self._surface(own, model.trainer_spec.unk_surface) for own in model.pieces]
        self.byte_ids = frozenset(self.bytes.values())
        #: Ids of words as bytes, which the garbage collector need not visit.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    @staticmethod
    def _word_pattern(pieces: Iterable[str]) -> str:
        """Runs of word letters, and runs of others, each with the blanks before: no piece holds a letter of both kinds.

        A word letter that stands beside another letter in some piece counts as one of the others.
        """
        pairs = {pair for piece in pieces for pair in zip(piece, piece[1:]) if BLANK not in pair}
        inner = {letter for pair in pairs for letter in pair if letter.isalnum()}
        while loose := {own for pair in pairs for own in pair if own in inner and not inner.issuperset(pair)}:
            inner -= loose
        others = re.escape("".join(sorted({"_", *(own for pair in pairs for own in pair if own.isalnum())} - inner)))
        return rf"{BLANK}*[^\W{others}]+|{BLANK}*(?:[^\w{BLANK}]|[{others}])+|{BLANK}+"

    @staticmethod
    def _surface(piece, unknown: str) -> bytes:
        if piece.type == _BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        if piece.type == _CONTROL:
            return b""
        return (unknown if piece.type == _UNKNOWN else piece.piece.replace(BLANK, " ")).encode()

    def encoded(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, slice by slice, the end id last."""
        if text:
            at, first = 0, BLANK
            while at < len(text):
                cut = _CUT.search(text, at + SLICE)
                stop = cut.start() if cut else len(text)
                yield self._encode_words(self.words(first + text[at:stop].replace(" ", BLANK)))
                at, first = stop, ""
        yield [self.end]

    def decoded(self, slices: Iterator[list[int]]) -> Iterator[str]:
        """The text that ids stand for; a byte that is no part of a letter becomes U+FFFD. Runs of bytes stay in a slice."""
        surface, start = self.surface, True
        for ids in slices:
            raw = b"".join([surface[own] for own in ids])
            if not raw:
                continue
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                text = self._decode_runs(ids)
            # The blank that encoding puts before a text.
            yield text[1:] if start and ids and self._opens_blank(ids) else text
            start = False

    def _opens_blank(self, ids: list[int]) -> bool:
        first = next((own for own in ids if self.surface[own]), -1)
        return first >= 0 and self.pieces[first].startswith(BLANK)

    def _decode_runs(self, ids: list[int]) -> str:
        """Bytes beside each other are read as letters; those that make none are replaced one by one."""
        parts, run = [], bytearray()

        def flush() -> None:
            while run:
                for size in range(min(4, len(run)), 0, -1):
                    try:
                        letter = run[:size].decode()
                    except UnicodeDecodeError:
                        continue
                    if len(letter) == 1:
                        break
                else:
                    size, letter = 1, "�"
                parts.append(letter)
                del run[:size]

        for own in ids:
            if own in self.byte_ids:
                run += self.surface[own]
            else:
                flush()
                parts.append(self.surface[own].decode())
        flush()
        return "".join(parts)

    def _encode_words(self, words: list[str]) -> list[int]:
        """Words met lately are remembered: when the newer half is full, it becomes the older one, which is forgotten."""
        known, older, found = self.known, self.older, []
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = older.get(word) or array("i", self._encode_word(word)).tobytes()
                if len(word) <= 64:
                    known[word] = ids
                    if len(known) > REMEMBERED:
                        self.older, self.known = older, known = known, {}
            found.append(ids)
        return np.frombuffer(b"".join(found), "=i4").tolist()

    def _encode_word(self, word: str) -> list[int]:
        size = len(word)
        # By their places from the end, in which the reversed word has them; the first one reported is the longest.
        longest = array("i", [-1]) * size
        for back, own in self.longest.iter(word[::-1]):
            if longest[back] < 0:
                longest[back] = own
        if min(longest) >= 0:
            return self._backtrack(longest, 0, size)
        ids, start = [], 0
        while start < size:
            stop = start
            while stop < size and longest[size - 1 - stop] >= 0:
                stop += 1
            if stop > start:
                ids += self._backtrack(longest, start, stop)
            if stop < size:
                ids += [self.bytes[own] for own in word[stop].encode()]
            start = stop + 1
        return ids

    def _backtrack(self, longest: array, start: int, stop: int) -> list[int]:
        """The pieces of letters that all have some piece."""
        sizes, shorter, pairs, top = self.sizes, self.shorter, self.pairs, len(longest) - 1
        failed = bytearray((stop >> 3) + 1)
        found, at, last, any_failed = [], start, -1, False
        own = longest[top - at]
        while True:
            while own >= 0:
                end = at + sizes[own]
                if not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                    fits = pairs.get((last, own))
                    if fits or fits is None and self.fits(last, own):
                        break
                own = shorter[own]
            if own >= 0:
                found.append(own)
                if end == stop:
                    return found
                at, last = end, own
                own = longest[top - at]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                found.pop()
                at -= sizes[last]
                own = shorter[last]
                last = found[-1] if found else -1

    def fits(self, left: int, right: int) -> bool:
        """Whether the letters of both pieces, merged again, give these two; -1 stands for the start of the text."""
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()
        want = [self.pieces[own] for own in (left, right) if own >= 0]
        answer = self.pairs[left, right] = self.merged("".join(want)) == want
        return answer

    def merged(self, letters: str) -> list[str]:
        """Merge by merge, the best-scored pair first and the leftmost of equals."""
        parts, ids, scores = list(letters), self.ids, self.scores
        while len(parts) > 1:
            best, place = None, -1
            for at, (left, right) in enumerate(zip(parts, parts[1:])):
                own = ids.get(left + right)
                if own is not None and (best is None or scores[own] > best):
                    best, place = scores[own], at
            if place < 0:
                break
            parts[place:place + 2] = [parts[place] + parts[place + 1]]
        return parts


@lru_cache(1)
def _pieces(path: str) -> Pieces:
    """One model per Python worker, whichever of its tasks comes first."""
    return Pieces(path)


def _loaded(path: str | None) -> Pieces:
    return _pieces(path or model_path())


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id and `ids`, the piece ids and the end id. `path` is where a task finds the model."""
    def start():
        pieces = _loaded(path)
        return lambda text: (np.fromiter(chain.from_iterable(pieces.encoded(text or "")), "<i4"),)

    return map_texts(docs, ["doc_id"], "ids array<int>", start)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id and the text that its ids stand for; null ids are those of an empty text."""
    def start():
        pieces = _loaded(path)
        return lambda ids: ("".join(pieces.decoded(iter([ids or []]))),)

    return map_texts(encoded, ["doc_id"], "text string", start, of="ids")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, number of ids, and the digests of its ids and of the text decoded from them.

    Encoding and decoding follow each other in the same task, so that neither ids nor texts travel further than that.
    """
    def start():
        pieces = _loaded(path)
        names = [str(own) for own in range(len(pieces.pieces))]

        def digests(text: str | None) -> tuple[int, str, str]:
            count, numbers, letters = 0, hashlib.sha256(), hashlib.sha256()

            def passing() -> Iterator[list[int]]:
                nonlocal count
                for ids in pieces.encoded(text or ""):
                    numbers.update((" " * (count > 0) + " ".join([names[own] for own in ids])).encode())
                    count += len(ids)
                    yield ids

            for part in pieces.decoded(passing()):
                letters.update(part.encode())
            return count, numbers.hexdigest(), letters.hexdigest()

        return digests

    return map_texts(docs, ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string", start)
