r"""Chat formatting with a grammar round trip.

A turn is written as `### Role: text</turn>` and a line break. Texts stand as they are, unless that would be read back as
something else: each rendered turn is parsed again by the grammar below, the recovered turn is compared to its source, and
what conflicts is escaped with a backslash, first only where it has to be, then everywhere, until both are identical.

    conversation = { turn }
    turn    = "### " role ": " text "</turn>" "\n"
    role    = "User" | "Assistant" | "System" | "=" escaped text
    text    = { "\\" | "\" control | any character that starts no control }
    control = "### User" | "### Assistant" | "### System" | "### =" | "</turn>" | ": " inside a role

Writing is done row by row, without a shuffle, and gives one segment per turn, so no conversation is ever held as a whole.
Read back, segments of a conversation run through one task in order, as a digest of them must; the task keeps only the
running digests, whatever the conversation's length.

Null texts and null roles count as empty. Turns are ordered by turn (null first), then role, then text, so that repeated
turns stay, next to each other. Rows with a null conversation id form one conversation. Empty tables give empty results;
other columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import map_texts

ROLES = {"user": "User", "assistant": "Assistant", "system": "System"}
END = "</turn>"
LEARNED = "assistant"

_KNOWN = {name: role for role, name in ROLES.items()}
_CONTROL = r"### (?:User|Assistant|System|=)|</turn>"
_ROLE_CONTROL = rf"{_CONTROL}|: "
_FOUND = {control: re.compile(control) for control in (_CONTROL, _ROLE_CONTROL)}
#: Backslashes that would be read as escapes: a run of several, or one before a control or the end.
_CONFLICT = {control: re.compile(rf"\\+(?={control}|\Z)|\\\\+|{control}") for control in (_CONTROL, _ROLE_CONTROL)}
_EVERYTHING = {control: re.compile(rf"\\|{control}") for control in (_CONTROL, _ROLE_CONTROL)}
_STEP = {control: re.compile(rf"\\(?:\\|{control})|{control}") for control in (_CONTROL, _ROLE_CONTROL)}
_SEGMENT = "segment string, loss_start long, loss_end long"


def _as_is(text: str, control: str) -> str:
    return text


def _conflicts_escaped(text: str, control: str) -> str:
    return _CONFLICT[control].sub(lambda own: own[0] * 2 if own[0][0] == "\\" else "\\" + own[0], text)


def _all_escaped(text: str, control: str) -> str:
    return _EVERYTHING[control].sub(lambda own: "\\" + own[0], text)


_LEVELS = (_as_is, _conflicts_escaped, _all_escaped)


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn's segment, and where in it the text stands; what the parser recovers from it is the turn itself."""
    for escaped in _LEVELS:
        name = ROLES.get(role) or "=" + escaped(role, _ROLE_CONTROL)
        head = f"### {name}: "
        body = escaped(text, _CONTROL)
        segment = f"{head}{body}{END}\n"
        try:
            if list(parse(segment)) == [(role, text)]:
                return segment, len(head), len(head) + len(body)
        except ValueError:
            pass
    raise ValueError(f"no escaping keeps a turn of {len(text)} characters")


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, unescaped; a ValueError for text that the grammar does not produce."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith("### ", at):
            raise ValueError(f"no turn starts at {at}")
        at += 4
        if formatted.startswith("=", at):
            role, at = _until(formatted, at + 1, ": ", _ROLE_CONTROL)
        else:
            end = formatted.find(": ", at)
            role = _KNOWN.get(formatted[at:end])
            if end < 0 or role is None:
                raise ValueError(f"no role at {at}")
            at = end + 2
        text, at = _until(formatted, at, END, _CONTROL)
        if not formatted.startswith("\n", at):
            raise ValueError(f"no line break at {at}")
        at += 1
        yield role, text


def _until(formatted: str, at: int, end: str, control: str) -> tuple[str, int]:
    """The unescaped text up to the next `end`, and where it goes on after it."""
    parts = []
    for step in _STEP[control].finditer(formatted, at):
        start, stop = step.span()
        parts.append(formatted[at:start])
        if step[0][0] != "\\":
            if step[0] != end:
                raise ValueError(f"a control stands unescaped at {start}")
            return "".join(parts), stop
        parts.append(step[0][1:])
        at = stop
    raise ValueError(f"no {end!r} after {at}")


def format_turns(conversations: DataFrame) -> DataFrame:
    """Per turn: conv_id, turn, its segment, and the part of the segment that the loss is taken over.

    The segments of a conversation, in the order of their turns, are its formatted text. Turns of other roles than the
    learned one have an empty loss span.
    """

    def start():
        def written(turn: dict) -> tuple[str, int, int]:
            role = turn["role"] or ""
            segment, first, last = render(role, turn["text"] or "")
            return (segment, first, last) if role == LEARNED else (segment, 0, 0)

        return written

    rows = conversations.select("conv_id", "turn", F.struct("role", "text").alias("said"))
    return map_texts(rows, ["conv_id", "turn", "said"], _SEGMENT, start, of="said")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of what is read back from segments that come in order, conversation by conversation."""
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    conversation, state = None, None

    def row() -> dict:
        n, turns, loss_chars, loss, chars = state
        return dict(zip(names, (conversation, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)))

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, pa.schema([
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
        ]))

    for batch in batches:
        rows = []
        for found, segment, first, last in zip(*(batch.column(name).to_pylist() for name in (
                "conv_id", "segment", "loss_start", "loss_end"))):
            if state is None or found != conversation:
                if state:
                    rows.append(row())
                conversation, state = found, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(segment):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            if last > first:
                learned, _ = _until(segment[first:last] + END, 0, END, _CONTROL)
                state[2] += len(learned)
                state[3].update(learned.encode())
            state[4] += len(segment)
        if rows:
            yield batch_of(rows)
    if state:
        yield batch_of([row()])


def report(conversations: DataFrame) -> DataFrame:
    """Per conversation: what is read back from its formatted text."""
    segments = format_turns(conversations.withColumn("conv_id", F.col("conv_id").cast("long")))
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "said.role", "said.text")
    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
