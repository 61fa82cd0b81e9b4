"""Masking and word matching."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F

# Words, the same on both sides of a match: each Han or Hiragana character by itself, otherwise runs of letters and digits.
_ALONE = r"\p{IsHan}\p{IsHiragana}"
_RUN = rf"[\p{{L}}\p{{N}}&&[^{_ALONE}]]"
_TOKEN = rf"[{_ALONE}]|{_RUN}+"
_BEFORE, _AFTER = rf"(?<!{_RUN})", rf"(?!{_RUN})"
# The same characters for a keyword, which is taken apart before it becomes part of a plan.
_ALONE_RANGES = "\u2e80-\u2fd5\u3005\u3007\u3021-\u3029\u3038-\u303b\u3041-\u309f\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufad9\U00020000-\U000323af"
_WORD = re.compile(rf"[{_ALONE_RANGES}]|(?:(?![{_ALONE_RANGES}])[^\W_])+")
_IS_ALONE = re.compile(rf"[{_ALONE_RANGES}]")


def mask_prefix(col: Column, keep: int, stars: int) -> Column:
    """The first `keep` characters followed by a fixed run of stars."""
    return F.concat(F.left(col, F.lit(keep)), F.lit("*" * stars))


def tokens(low: Column) -> Column:
    """Words of a lower-case text.

    A text of ASCII letters alone, or without characters that are words by themselves, is split at what is no word, which
    is far quicker than trying the whole pattern at each character.
    """
    def parts(gap: str) -> Column:
        return F.array_remove(F.split(low, gap), "")

    ascii_only = F.octet_length(low) == F.char_length(low)
    return F.when(ascii_only, parts("[^a-z0-9]+")).when(
        ~F.regexp_like(low, F.lit(f"[{_ALONE}]")), parts(r"[^\p{L}\p{N}]+")
    ).otherwise(F.regexp_extract_all(low, F.lit(_TOKEN), F.lit(0)))


def query_words(keyword: str | None) -> list[str]:
    """Distinct words of a search keyword, in the order given; they become literals in the plan."""
    return list(dict.fromkeys(_WORD.findall((keyword or "").lower())))


def has_word(low: Column, words: list[str]) -> Column:
    """True where one of `words` stands in a lower-case text as a whole word; null where there is no text.

    A plain substring test comes first and lets most rows skip the pattern; no word list is built. A character that is a
    word by itself needs no more than that test.
    """
    alone = [F.contains(low, F.lit(word)) for word in words if _IS_ALONE.match(word)]
    runs = [word for word in words if not _IS_ALONE.match(word)]
    if not runs:
        return reduce(or_, alone)
    mentioned = reduce(or_, [F.contains(low, F.lit(word)) for word in runs])
    bounded = mentioned & F.regexp_like(low, F.lit(f"{_BEFORE}(?:{'|'.join(runs)}){_AFTER}"))
    return reduce(or_, [*alone, bounded])


def match_all(col: Column, keyword: str | None) -> Column:
    """True where every word of the keyword occurs; an empty keyword matches nothing."""
    words, low = query_words(keyword), F.lower(col)
    if not words:
        return F.lit(False)
    return F.coalesce(reduce(and_, [has_word(low, [word]) for word in words]), F.lit(False))


def match_any(col: Column, keyword: str | None) -> Column:
    """True where at least one word of the keyword occurs."""
    words = query_words(keyword)
    return F.coalesce(has_word(F.lower(col), words), F.lit(False)) if words else F.lit(False)
