"""Recency, frequency and monetary features over look-back windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from trolley.functions.columns import net_price
from trolley.functions.dates import column_type, days_before, floor_days_text, time_literal
from trolley.operators.ordering import joined_on

PAIR = ("customer_id", "item_id")
CUSTOMER = ("customer_id",)

# Look-back horizons in days and the penalty for "never".
WINDOWS = (1, 7, 30, 60, 90, 360)
WINDOWS_LONG = (1, 7, 30, 60, 90, 360, 720)
PENALTY = 999


def dated(df: DataFrame, ref: datetime | None) -> DataFrame:
    """The table with its reference date as column ``rd``: a fixed date folds into the plan as
    a literal, without one the rows bring their own ``rd``."""
    return df if ref is None else df.withColumn("rd", time_literal(ref, column_type(df, "InvoiceDate")))


def with_net_price(df: DataFrame) -> DataFrame:
    return df.withColumn("net_price", net_price(F.col("item_amt"), F.col("item_qty")))


def with_ref_dates(df: DataFrame, windows: Sequence[int] = WINDOWS, ref: datetime | None = None) -> DataFrame:
    """Add ``rd`` and one ``rd<w>`` per window.

    Without ``ref`` each customer's own latest date is used; it comes from a partial
    aggregate joined back, so a customer with very many rows is split by the skew join.
    """
    if ref is None:
        df = joined_on(df, df.groupBy(*CUSTOMER).agg(F.max("InvoiceDate").alias("rd")), CUSTOMER)
    return dated(df, ref).select("*", *[days_before(F.col("rd"), w).alias(f"rd{w}") for w in windows])


def window_features(windows: Sequence[int], prefix: str = "", amount: Sequence[str] = ("sum",),
                    quantity: Sequence[str] = ("sum",), net: bool = False, sep: str = "") -> list[Column]:
    """Aggregates of all windows back from ``rd`` at once; an empty window gives NULL, not 0."""
    out = []
    for window in windows:
        inside = f"FILTER (WHERE InvoiceDate >= rd - INTERVAL '{int(window)}' DAY)"
        out.append(f"nullif(count(transaction_id) {inside}, 0L) AS {prefix}F{window}")
        for letter, column, kinds in (("M", "item_amt", amount), ("Q", "item_qty", quantity)):
            for kind in kinds:
                name = f"{prefix}{letter}{window}" + (f"{sep}{kind}" if len(kinds) > 1 else "")
                out.append(f"{kind}({column}) {inside} AS {name}")
        if net:
            out.append(f"sum(net_price) {inside} AS {prefix}N{window}")
    return [F.expr(text) for text in out]


def recency_features(letter: str) -> list[Column]:
    """Days from the last (``_L``) and the first (``_F``) purchase to ``rd``."""
    return [F.expr(floor_days_text("max(rd)", f"{pick}(InvoiceDate)") + f" AS {letter}_{end}")
            for pick, end in (("max", "L"), ("min", "F"))]


def span_feature(name: str) -> Column:
    return F.expr(floor_days_text("max(InvoiceDate)", "min(InvoiceDate)") + f" AS {name}")


def _windowed(df: DataFrame, keys: Sequence[str], windows: Sequence[int], ref: datetime | None, prefix: str,
              **options) -> DataFrame:
    if options.get("net") and "net_price" not in df.columns:
        df = with_net_price(df)
    df = with_ref_dates(df, (), ref)
    return (df.filter(F.col("InvoiceDate") >= days_before(F.col("rd"), max(windows)))
            .groupBy(*keys).agg(*window_features(windows, prefix, **options)))


def pair_rfm(df: DataFrame, windows: Sequence[int] = WINDOWS, ref: datetime | None = None,
             keys: Sequence[str] = PAIR, **options) -> DataFrame:
    """F/M/Q of each (customer, item) for every window in one aggregation.

    Replaces one aggregate per window glued by outer joins: one scan, one shuffle, and
    map-side partial sums, so neither the window count nor a hot customer adds shuffles.
    """
    return _windowed(df, keys, windows, ref, "", **options)


def customer_rfm(df: DataFrame, windows: Sequence[int] = WINDOWS_LONG, ref: datetime | None = None,
                 keys: Sequence[str] = CUSTOMER, **options) -> DataFrame:
    return _windowed(df, keys, windows, ref, "C", **options)


def rfm_join(parts: Sequence[DataFrame], keys: Sequence[str] = PAIR) -> DataFrame:
    """Full outer chain of separately aggregated windows (kept as the check of pair_rfm)."""
    return reduce(lambda a, b: a.join(b, list(keys), "outer"), parts)


def recency(df: DataFrame, ref: datetime, keys: Sequence[str] = PAIR, letter: str = "R") -> DataFrame:
    return dated(df, ref).groupBy(*keys).agg(*recency_features(letter))


def span_days(df: DataFrame, keys: Sequence[str] = PAIR, name: str = "R_F") -> DataFrame:
    """Days between the first and the last purchase."""
    return df.groupBy(*keys).agg(span_feature(name))
