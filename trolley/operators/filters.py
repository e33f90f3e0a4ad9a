"""Row filters and semi/anti joins."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from trolley.functions.dates import column_type, reference_date, time_literal
from trolley.operators.ordering import joined_on
from trolley.operators.rfm import CUSTOMER


def time_split(df: DataFrame, cut: datetime | str, ts: str = "InvoiceDate") -> tuple[DataFrame, DataFrame]:
    """Rows before the cut and rows from the cut on."""
    at = time_literal(cut, column_type(df, ts))
    return df.filter(F.col(ts) < at), df.filter(F.col(ts) >= at)


def as_of(df: DataFrame, days: int, ts: str = "InvoiceDate") -> DataFrame:
    """Rows up to ``days`` days before the table's latest time."""
    return df.filter(F.col(ts) <= time_literal(reference_date(df, ts, days), column_type(df, ts)))


def only_items(df: DataFrame, targets: Sequence[str], column: str = "item_id") -> DataFrame:
    return df.filter(F.col(column).isin(*targets))


def restrict_to(df: DataFrame, keys: DataFrame, on: Sequence[str] = CUSTOMER) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_semi")


def not_in(df: DataFrame, keys: DataFrame, on: Sequence[str] = CUSTOMER) -> DataFrame:
    """Rows without a partner; rows with a NULL key have none and stay."""
    return df.join(keys.select(*on), list(on), "left_anti")


def in_scope(df: DataFrame, items: DataFrame, column: str = "item_id") -> DataFrame:
    return df.join(items.select(column), column, "left_semi")


def missing_from(template: DataFrame, scored: DataFrame, on: Sequence[str] = CUSTOMER) -> DataFrame:
    return not_in(template, scored, on)


def valid_keys(df: DataFrame, column: str = "customer_id", invalid=0) -> DataFrame:
    return df.filter(F.col(column) != F.lit(invalid))


def group_size(df: DataFrame, keys: Sequence[str] = CUSTOMER, name: str = "count") -> DataFrame:
    """Group size on every row: a partial count joined back, not one task per group."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return joined_on(df, sizes, keys)


def min_activity(df: DataFrame, n: int, keys: Sequence[str] = CUSTOMER) -> DataFrame:
    """Rows of keys with more than ``n`` rows."""
    active = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > n)
    return joined_on(df, active.select(*keys), keys, "left_semi")


def label_rows(df: DataFrame, targets: Sequence[str], rank: str = "rank") -> DataFrame:
    """Newest-visit purchases of target items with a positive quantity."""
    return df.filter(F.col("item_id").isin(*targets) & (F.col(rank) <= 1) & (F.col("item_qty") > 0))


def clean_scores(df: DataFrame, intercept=None, item: str = "item_id", score: str = "score") -> DataFrame:
    kept = df.filter(F.col(score) != 0)
    return kept if intercept is None else kept.filter(F.col(item) != F.lit(intercept))


def error_rows(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.filter(F.col(label) != F.col(prediction))
