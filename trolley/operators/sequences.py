"""Purchase sequences, newest first."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from trolley.functions.dates import column_type, floor_days, time_literal
from trolley.functions.text import tag
from trolley.operators.ordering import HOT_ROWS, position_in_key
from trolley.operators.rfm import CUSTOMER

SEP = ", "


def sequence_steps(df: DataFrame, ref: datetime | Column, keys: Sequence[str] = CUSTOMER, prefix: str = "",
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Long form: one row per purchase with its 1-based ``position`` (newest first; purchases of
    one time by item, quantity, amount) and its day offset from the reference date."""
    when = ref if isinstance(ref, Column) else time_literal(ref, column_type(df, "InvoiceDate"))
    steps = df.select(*keys, "InvoiceDate", "item_id", "item_qty", "item_amt",
                      floor_days(F.col("InvoiceDate"), when).alias("days"))
    placed = position_in_key(steps, keys, "InvoiceDate", [F.asc("item_id"), F.asc("item_qty"), F.asc("item_amt")],
                             hot_rows=hot_rows)
    return placed.withColumn("item_id", tag(prefix, F.col("item_id")) if prefix else F.col("item_id"))


def sequence(steps: DataFrame, keys: Sequence[str] = CUSTOMER, steps_per_row: int = 1000) -> DataFrame:
    """Delimited strings of whole sequences.

    A row holds at most ``steps_per_row`` steps; longer sequences continue in the rows with
    the next ``part``. Nothing is dropped, and no group outgrows a task.
    """
    entry = F.struct("position", "item_id", "item_qty", "item_amt", "days")
    part = F.floor((F.col("position") - 1) / F.lit(steps_per_row)).cast("long")
    rows = (steps.groupBy(*keys, part.alias("part"))
            .agg(F.array_sort(F.collect_list(entry)).alias("_s")))

    def joined(field: str) -> Column:
        return F.array_join(F.transform("_s", lambda e: e[field].cast("string")), SEP)

    return rows.select(
        *keys, "part", F.size("_s").cast("long").alias("steps"),
        joined("item_id").alias("categorical_sequence_items"),
        joined("item_qty").alias("continuous_sequence_qty"),
        joined("item_amt").alias("continuous_sequence_amt"),
        joined("days").alias("continuous_sequence_days"))


def first_steps(steps: DataFrame, n: int, keys: Sequence[str] = CUSTOMER) -> DataFrame:
    """The n newest steps per customer, the model input. With the position as a plain filter the limit
    reaches the window that numbers the steps, and with it the tasks before the shuffle."""
    return steps.filter(F.col("position") <= n)
