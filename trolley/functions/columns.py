"""Row-wise cleaning and feature expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def net_price(amount: Column, quantity: Column) -> Column:
    return amount * quantity


def log_shift(value: Column, shift: float) -> Column:
    """ln(value + shift); NULL below -shift, where the logarithm is undefined."""
    return F.when(value + shift > 0, F.log(value + F.lit(float(shift))))


def row_sum(columns: Sequence[str]) -> Column:
    """Sum over columns of one row, NULL counted as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def to_number(value: Column, strict: bool = True) -> Column:
    return value.cast("double") if strict else value.try_cast("double")


def cast_key(value: Column) -> Column:
    """String key to integer by way of a number (``"12.0"`` is 12)."""
    return value.cast("double").cast("long")


def recode(value: Column, mapping: Mapping) -> Column:
    """Replace by a literal dictionary; values without an entry pass through."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def null_sentinels(value: Column, sentinels: Sequence[str]) -> Column:
    return F.when(~value.isin(*sentinels), value)


def argmax(scores: Sequence[str]) -> Column:
    """Name of the largest score column; the first one wins a tie."""
    entries = [F.struct(F.col(c).alias("score"), F.lit(-i).alias("place"), F.lit(c).alias("name"))
               for i, c in enumerate(scores)]
    return F.array_max(F.array(*entries))["name"]
