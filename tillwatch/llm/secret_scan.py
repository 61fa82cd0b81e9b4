"""Secret scans with a recursive decoding worklist.

A text is scanned for three kinds of secrets. Whatever in it looks encoded (percent signs, Unicode escapes, base64, and
compressed bytes inside base64) becomes a further layer, which is scanned and unwrapped in turn until no layer yields a
new one. A layer seen before at the same place ends there, so that content which decodes to itself stops. Spans found in a
layer are mapped to the source text: character by character through percent signs and escapes, to the whole encoded run
through base64.

Base64 is read at each of four alignments, as text before it may shift it, and compressed streams are looked for anywhere
in it; bytes that are no UTF-8 hide nothing beside them. Base64 wrapped over lines is one run from its first line to its
last, and each line is a run, too; a find of a line that its whole run has as well is listed once, for the whole run.

Null text counts as empty and holds no span. Repeated rows get equal results, an empty table an empty result; `redact`
carries other columns along. A layer that would unpack to more than LAYER_BYTES is not unpacked, but its run is reported
as `decoded_oversized`, so a reader never takes it for clean.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import map_texts

#: Bound on what one compressed run may unpack to in a task's memory.
LAYER_BYTES = 16 << 20
KINDS = ("assign", "access", "hex", "decoded_assign", "decoded_access", "decoded_hex", "decoded_oversized")
BASE_KINDS = KINDS[:3]
MASK = "[secret]"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: Each assignment's name holds one of these.
_NAMES = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: What may stand between two lines of wrapped base64: a line break, with what quotes or indents the next line.
_BREAK = re.compile(r"[ \t]*(?:\r\n|\r|\n)[ \t>#*|]*")
_PIECE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_LINE_END = re.compile(r"[ \t]*(?:[\r\n]|$)")
#: Line lengths that encoders wrap base64 at.
_WIDTHS = frozenset((60, 64, 70, 72, 76))
#: How gzip, zlib and bzip2 streams start.
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]")
#: Compressed bytes are unpacked so many at a time: what stands before a damaged place is kept.
_PIECE_BYTES = 256
_TO_STANDARD = str.maketrans("-_", "+/")


class Places:
    """Where the letters of a layer stand in the source, piece by piece.

    A piece is a run of letters that stand there as they are, or one letter with the span it was decoded from; so a layer
    takes 24 bytes for each of its decoded letters and runs between them, not for each letter.
    """

    def __init__(self) -> None:
        self.at, self.first, self.last, self.size = array("q"), array("q"), array("q"), 0

    def add(self, size: int, first: int, last: int) -> None:
        if size <= 0:
            return
        if self.at and size == last - first and self.last[-1] == first and self.size - self.at[-1] == first - self.first[-1]:
            self.last[-1] = last
        else:
            self.at.append(self.size)
            self.first.append(first)
            self.last.append(last)
        self.size += size

    def pieces(self, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(size, first, last) of the pieces of the letters from `start` to `end`."""
        number = bisect_right(self.at, start) - 1
        while start < end:
            at, first, last = self.at[number], self.first[number], self.last[number]
            until = self.at[number + 1] if number + 1 < len(self.at) else self.size
            stop = min(end, until)
            if until - at == last - first:
                yield stop - start, first + start - at, first + stop - at
            else:
                yield stop - start, first, last
            start, number = stop, number + 1

    def add_from(self, layer: Layer, start: int, end: int) -> None:
        if layer.places is None:
            self.add(end - start, start, end)
        else:
            for piece in layer.places.pieces(start, end):
                self.add(*piece)

    def span(self, start: int, end: int) -> tuple[int, int]:
        first = next(self.pieces(start, start + 1))[1]
        return first, next(self.pieces(end - 1, end))[2]


@dataclass
class Layer:
    """A text and where it stands in the source: letter by letter, or one span for all of them; None for the source."""

    text: str
    places: Places | tuple[int, int] | None

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.places is None:
            return start, end
        return self.places if isinstance(self.places, tuple) else self.places.span(start, end)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets that stand in the text itself; the end is exclusive."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        found += [("assign", *own.span()) for own in _ASSIGN.finditer(text) if len(own[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *own.span()) for own in _ACCESS.finditer(text)]
    found += [("hex", *own.span()) for own in _HEX.finditer(text)]
    return found


def all_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans and those of every layer below, by start, then kind, then end."""
    own = base_spans(text)
    found = set(own)
    base = {(kind, start, end) for kind, start, end in own}
    waiting = [Layer(text, None)]
    seen, joined = set(), set()
    while waiting:
        layer = waiting.pop()
        if not isinstance(layer, Layer):  # the layers of a base64 run, which are made one at a time
            runs, layer = layer, next(layer, None)
            if layer is None:
                continue
            waiting.append(runs)
        if layer.places is not None:
            key = (hashlib.blake2b(layer.text.encode("utf-8", "replace"), digest_size=16).digest(), layer.place(0, len(layer.text)))
            if key in seen:
                continue
            seen.add(key)
            for kind, start, end in base_spans(layer.text):
                place = layer.place(start, end)
                if (kind, *place) not in base:
                    found.add((f"decoded_{kind}", *place))
        waiting.extend(_unwrapped(layer, found, joined))
    whole = [span for span in found if span[1:] in joined and span[0] not in BASE_KINDS]
    for kind, start, end in whole:
        found -= {span for span in found if span[0] == kind and start <= span[1] and span[2] <= end and span[1:] != (start, end)}
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def _unwrapped(layer: Layer, found: set, joined: set) -> Iterator[Layer | Iterator[Layer]]:
    if "%" in layer.text:
        yield from _replaced(layer, _PERCENT, _percent_decoded)
    if "\\" in layer.text:
        yield from _replaced(layer, _ESCAPE, _unescaped)
    for run, start, end in _base64_runs(layer.text):
        place = layer.place(start, end)
        if len(run) < end - start:
            joined.add(place)
        yield _base64_layers(run, place, found)


def _base64_layers(run: str, place: tuple[int, int], found: set) -> Iterator[Layer]:
    for text in _base64_texts(run):
        if text is None:
            found.add(("decoded_oversized", *place))
        elif text:
            yield Layer(text, place)


def _base64_runs(text: str) -> Iterator[tuple[str, int, int]]:
    """Base64 runs with their start and end: each by itself, and those of consecutive lines joined without line breaks."""
    reached = 0
    for run in _BASE64.finditer(text):
        yield run[0], *run.span()
        if run.start() >= reached:
            pieces, end = _wrapped(text, run)
            if len(pieces) > 1:
                reached = end
                yield "".join(pieces), run.start(), end


def _wrapped(text: str, run: re.Match) -> tuple[list[str], int]:
    """The lines of wrapped base64 that starts with the run, and their end. All but the last are of one length, except that
    the first may share its line with other text."""
    pieces, end, width = [run[0]], run.end(), len(run[0])
    while not pieces[-1].endswith("="):
        gap = _BREAK.match(text, end)
        piece = gap and _PIECE.match(text, gap.end())
        if not piece:
            break
        size = len(piece[0])
        if len(pieces) == 1 and size in _WIDTHS and width not in _WIDTHS:
            width = size
        if size > width:
            break
        if size < width and not piece[0].endswith("="):
            # Without padding, the last line must look like one: the next word of a text may follow a single line, too.
            whole = (sum(map(len, pieces)) + size) % 4 == 0
            if not (whole or _LINE_END.match(text, piece.end())) or not (len(pieces) > 1 or width in _WIDTHS):
                break
        pieces.append(piece[0])
        end = piece.end()
        if size < width:
            break
    return pieces, end


def _replaced(layer: Layer, pattern: re.Pattern, decoded) -> Iterator[Layer]:
    """The whole layer with its encoded runs decoded, as what names a secret may stand outside the run."""
    parts, at = [], 0
    whole = isinstance(layer.places, tuple)  # all letters stand at the same place
    places = layer.places if whole else Places()
    for run in pattern.finditer(layer.text):
        start, end = run.span()
        parts.append(layer.text[at:start])
        if not whole:
            places.add_from(layer, at, start)
        letters = []
        for letter, first, last in decoded(run[0]):
            letters.append(letter)
            if not whole:
                places.add(1, *layer.place(start + first, start + last))
        parts.append("".join(letters))
        at = end
    if parts:
        parts.append(layer.text[at:])
        if not whole:
            places.add_from(layer, at, len(layer.text))
        yield Layer("".join(parts), places)


def _percent_decoded(run: str) -> Iterator[tuple[str, int, int]]:
    """The letters of a run; a byte that is no UTF-8 is a letter by itself, by Latin-1."""
    at = 0
    for letter in bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape"):
        stray = "\udc80" <= letter <= "\udcff"
        width = 3 if stray else 3 * len(letter.encode("utf-8"))
        yield chr(ord(letter) - 0xDC00) if stray else letter, at, at + width
        at += width


def _unescaped(run: str) -> Iterator[tuple[str, int, int]]:
    """The letters of a run; a surrogate without its other half is a letter that stands for none."""
    def unit(at: int) -> tuple[int, int]:
        width = 6 if run[at + 1] == "u" else 4
        return int(run[at + 2:at + width], 16), at + width

    at = 0
    while at < len(run):
        code, end = unit(at)
        if 0xD800 <= code < 0xDC00 and end < len(run):
            low, after = unit(end)
            if 0xDC00 <= low < 0xE000:
                code, end = 0x10000 + ((code - 0xD800) << 10) + low - 0xDC00, after
        yield "\ufffd" if 0xD800 <= code < 0xE000 else chr(code), at, end
        at = end


def _base64_texts(run: str) -> Iterator[str | None]:
    """The texts a base64 run may stand for; None for one that is too large.

    What stands before base64 without a break, such as a path, shifts it: the run is read from its first four places, which
    are all there are. Bytes that are no UTF-8 are replaced, and hide nothing beside them.
    """
    plain = run.rstrip("=").translate(_TO_STANDARD)
    waiting, seen = [_aligned(plain)], set()
    while waiting:
        raw = next(waiting[-1], None)
        if raw is None:
            waiting.pop()
        elif len(raw) > LAYER_BYTES and len(waiting) > 1:
            yield None
        elif (digest := hashlib.blake2b(raw, digest_size=16).digest()) not in seen:
            seen.add(digest)
            yield raw.decode("utf-8", "replace")
            waiting.append(_unpacked(raw))


def _aligned(plain: str) -> Iterator[bytes]:
    for at in range(4):
        own = plain[at:len(plain) - ((len(plain) - at) % 4 == 1)]
        yield base64.b64decode(own + "=" * (-len(own) % 4))


def _unpacked(raw: bytes) -> Iterator[bytes]:
    """What gzip, zlib and bzip2 streams anywhere in the bytes hold, each one byte beyond the bound at most."""
    at = 0
    while packed := _PACKED.search(raw, at):
        start = packed.start()
        unpacked, after = _stream(raw, start)
        at = max(after, start + 1)
        if unpacked:
            yield unpacked


def _stream(raw: bytes, start: int) -> tuple[bytes, int]:
    """What a stream holds as far as it can be read, and where to look for the next one."""
    stream = bz2.BZ2Decompressor() if raw[start:start + 1] == b"B" else zlib.decompressobj(47)
    parts, size, at = [], 0, start
    try:
        while at < len(raw) and not stream.eof and size <= LAYER_BYTES:
            piece = raw[at:at + _PIECE_BYTES]
            at += len(piece)
            parts.append(stream.decompress(piece, LAYER_BYTES + 1 - size))
            size += len(parts[-1])
    except (zlib.error, OSError, ValueError, EOFError):
        return b"".join(parts), start
    return b"".join(parts), at - len(stream.unused_data) if stream.eof else len(raw)


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id and its spans as an array of (kind, start, end)."""

    def start():
        return lambda text: ([dict(zip(("kind", "start", "end"), span)) for span in all_spans(text or "")],)

    return map_texts(docs, ["doc_id"], "spans array<struct<kind: string, start: long, end: long>>", start)


def redacted(text: str) -> str:
    """The text with every span masked; spans that overlap are masked as one."""
    parts, at = [], 0
    for _, start, end in all_spans(text):
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if parts else text


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their secrets masked, `n_chars` (where there is one) counted anew, other columns as they were."""
    others = [name for name in docs.columns if name != "text"]

    def start():
        return lambda text: (None if text is None else redacted(text),)

    masked = map_texts(docs.withColumnRenamed("text", "_unmasked"), others, "text string", start, of="_unmasked")
    if "n_chars" in others:
        masked = masked.withColumn("n_chars", F.coalesce(F.char_length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """Per document: spans counted by kind, the digest of the base ones, and all of them listed."""

    def start():
        def reported(text: str | None) -> tuple:
            spans = all_spans(text or "")
            base = [span for span in spans if span[0] in BASE_KINDS]
            kinds = [kind for kind, _, _ in base]
            return *map(kinds.count, BASE_KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)

        return reported

    return map_texts(
        docs, ["doc_id"], "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", start)
