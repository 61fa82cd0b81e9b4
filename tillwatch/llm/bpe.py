"""BPE encoding and decoding with a public vocabulary.

Words are merged over a contiguous array: the boundaries of a word's parts stand beside the ranks of the pairs that meet
there; the least rank is looked up by a scan, its boundary deleted, and the ranks of the two neighbours taken anew. A scan
per merge is quickest for the short words that texts consist of; a run of letters without end is merged with a heap
over the same ranks instead, in the same order, so that its cost does not grow with the square of its length.

Letters are those of the Unicode tables in the `regex` library; letters added to Unicode after the vocabulary's own library
was built are split off differently.

Null text counts as empty, an empty text has no tokens and decodes to an empty text. Rows are independent: repeated rows
get equal results, an empty table an empty result, and no column but the text is looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame

from tillwatch.llm.common import map_texts

VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a task remembers; beyond that it starts anew, so that its memory stays bounded.
REMEMBERED = 400_000
#: Parts from which a heap finds the least rank; below, a scan is quicker.
SCANNED = 64
_NEVER = 1 << 60

#: White space as the vocabulary's own pattern understands it.
_SPACE = r"\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


class Tokenizer:
    """Encodes and decodes with the merges of a vocabulary file whose words end in a marked letter."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.special = {own["content"]: own["id"] for own in model["added_tokens"]}
        model = model["model"]
        self.ids = dict(model["vocab"])
        self.end = model["end_of_word_suffix"]
        self.tokens = [""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for token, number in (*self.ids.items(), *self.special.items()):
            self.tokens[number] = token
        self.merges = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        self.letters = [self.ids[own] for own in _byte_letters()]
        self.last_letters = [self.ids[own + self.end] for own in _byte_letters()]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self._encode_plain(text)
        parts = []
        for part in self.split_special(text):
            if part in self.special:
                parts.append(self.special[part].to_bytes(4, "little"))
            elif part:
                parts.append(self._encode_plain(part))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """Tokens one blank apart, which is how a vocabulary without a decoder of its own is read back."""
        tokens = self.tokens
        return " ".join([tokens[number] for number in np.frombuffer(ids, "<u4").tolist()])

    def _encode_plain(self, text: str) -> bytes:
        # Letters are lowered one by one, so a final sigma is no special case.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        words = _WORD.findall(text)
        known = self.known
        try:
            return b"".join([known[word] for word in words])
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        found = []
        for word in words:
            own = known.get(word)
            if own is None:
                own = np.array(self.merge(word), "<u4").tobytes()
                if len(own) <= 4 * SCANNED:
                    known[word] = own
            found.append(own)
        return b"".join(found)

    def merge(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        parts = [self.letters[byte] for byte in raw[:-1]]
        parts.append(self.last_letters[raw[-1]])
        return self._merge_by_scan(parts) if len(parts) <= SCANNED else self._merge_by_heap(parts)

    def _merge_by_scan(self, parts: list[int]) -> list[int]:
        merges, never = self.merges, (_NEVER, 0)
        found = [merges.get(pair, never) for pair in zip(parts, parts[1:])]
        while found:
            least = min(found)
            if least[0] == _NEVER:
                break
            at = found.index(least)
            parts[at] = least[1]
            del parts[at + 1], found[at]
            if at:
                found[at - 1] = merges.get((parts[at - 1], parts[at]), never)
            if at < len(found):
                found[at] = merges.get((parts[at], parts[at + 1]), never)
        return parts

    def _merge_by_heap(self, parts: list[int]) -> list[int]:
        """The same merges in the same order (least rank, then leftmost), for long words."""
        merges = self.merges
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap = [
            (merges[pair][0], at, *pair) for at, pair in enumerate(zip(parts, parts[1:])) if pair in merges
        ]
        heapq.heapify(heap)
        while heap:
            _, at, left, right = heapq.heappop(heap)
            then = after[at]
            if then < 0 or parts[at] != left or parts[then] != right:
                continue
            parts[at] = merges[left, right][1]
            parts[then] = -1
            after[at] = after[then]
            if after[at] >= 0:
                before[after[at]] = at
            for own in (before[at], at):
                if own >= 0 and after[own] >= 0 and (pair := (parts[own], parts[after[own]])) in merges:
                    heapq.heappush(heap, (merges[pair][0], own, *pair))
        return [part for part in parts if part >= 0]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id and `ids`, the token ids as little-endian unsigned 32-bit integers."""
    path = path or vocabulary_path()

    def start():
        tokenizer = Tokenizer(path)
        return lambda text: (tokenizer.encode(text or ""),)

    return map_texts(docs, ["doc_id"], "ids binary", start)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id and the text that its ids stand for; null ids are those of an empty text."""
    path = path or vocabulary_path()

    def start():
        tokenizer = Tokenizer(path)
        return lambda ids: (tokenizer.decode(ids or b""),)

    return map_texts(encoded, ["doc_id"], "text string", start, of="ids")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, number of tokens, and the digests of its ids and of the text decoded from them.

    Encoding and decoding follow each other in the same task, so that neither ids nor texts travel further than that.
    """
    path = path or vocabulary_path()

    def start():
        tokenizer = Tokenizer(path)

        def digests(text: str | None) -> tuple[int, str, str]:
            ids = tokenizer.encode(text or "")
            decoded = tokenizer.decode(ids).encode("utf-8")
            return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

        return digests

    return map_texts(docs, ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string", start)
