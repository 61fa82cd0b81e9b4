"""Percent shares, cut (not rounded) to one decimal."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def share(part: Column, total: Column) -> Column:
    """`part` of `total` in percent with one decimal, cut; null where `total` is 0."""
    tenths = F.call_function("div", part.cast("bigint") * 1000, F.nullif(total, F.lit(0)))
    return tenths / F.lit(10.0)


def remainder(*shares: Column) -> Column:
    """What the given shares leave of 100; rounded, as 100 - 33.3 - 33.3 is not exactly 33.4 in binary."""
    return F.round(F.lit(100.0) - reduce(add, shares), 1)


def bucket(value: Column, width: int, top: int) -> Column:
    """Lower edge of the `width`-wide bucket of `value`; everything from `top` on shares the last one."""
    return F.least(F.floor(value / width) * width, F.lit(top)).cast("bigint")
