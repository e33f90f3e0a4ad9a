"""Repeatable pseudo-random draws.

A draw depends only on the row's key and a seed, so a retried task, another partition
count or another engine gives the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DRAW_RANGE = 1 << 32


def draw(seed: int, *keys: Column) -> Column:
    """Integer in [0, 2**32) from md5 of the keys and the seed."""
    text = F.concat_ws(":", *[k.cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def draw_order(seed: int, *keys: Column) -> Column:
    """128-bit draw as text, to order by: ties are not expected even on huge tables."""
    return F.md5(F.concat_ws(":", *[k.cast("string") for k in keys], F.lit(str(seed))))
