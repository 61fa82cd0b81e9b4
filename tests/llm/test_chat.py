from __future__ import annotations

import hashlib
import random

import pytest

from tillwatch.llm import chat


def test_every_turn_is_read_back():
    chance = random.Random(3)
    pieces = ["\\", "### User", "### ", "</turn>", "### =", ": ", "a", "\n", "</tur", "n>", "é"]
    for _ in range(20_000):
        text = "".join(chance.choice(pieces) for _ in range(chance.randrange(8)))
        role = chance.choice(["user", "assistant", "system", "", text, "tool: a", "=", "\\"])
        segment, first, last = chat.render(role, text)
        assert list(chat.parse(segment * 2)) == [(role, text)] * 2
        assert chat._until(segment[first:last] + chat.END, 0, chat.END, chat._CONTROL)[0] == text


def test_plain_text_stands_as_it_is():
    assert chat.render("user", "# A\\b ### c")[0] == "### User: # A\\b ### c</turn>\n"
    assert chat.render("assistant", "\\### Assistant: </turn> ok")[0] == (
        "### Assistant: \\\\\\### Assistant: \\</turn> ok</turn>\n")


@pytest.mark.parametrize("text", ["x", "### User: a", "### Nobody: a</turn>\n", "### User: a</turn>"])
def test_other_text_is_refused(text):
    with pytest.raises(ValueError):
        list(chat.parse(text))


def test_digests(spark):
    turns = spark.createDataFrame(
        [(1, 1, "assistant", "b", 0), (1, 0, "user", "a\\", 0), (1, 2, "assistant", None, 0), (1, 2, "assistant", None, 0),
         (None, None, None, None, 0)], "conv_id long, turn long, role string, text string, segment int")
    found = {row["conv_id"]: row for row in chat.report(turns).collect()}
    assert found[1]["n_turns"] == 4 and found[1]["loss_chars"] == 1
    assert found[1]["turns_sha256"] == hashlib.sha256(b"user\na\\\nassistant\nb\nassistant\n\nassistant\n\n").hexdigest()
    assert found[1]["loss_sha256"] == hashlib.sha256(b"b").hexdigest()
    assert found[None]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest()
    segments = "".join(row["segment"] for row in chat.format_turns(turns).filter("conv_id = 1").orderBy("turn").collect())
    assert found[1]["formatted_chars"] == len(segments)
    assert chat.report(turns.limit(0)).count() == 0
