"""Time arithmetic with floor semantics."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

DAY_MICROS = 86_400_000_000
HOUR_MICROS = 3_600_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def floor_div(value: Column, step: int) -> Column:
    """Exact integer floor division (``div`` truncates towards zero)."""
    return ((value - F.pmod(value, F.lit(step))) / F.lit(step)).cast("long")


def floor_days_text(later: str, earlier: str) -> str:
    """``floor_days`` as SQL text, for aggregates written as many expressions at once."""
    gap = f"(unix_micros(CAST({later} AS TIMESTAMP)) - unix_micros(CAST({earlier} AS TIMESTAMP)))"
    return f"({gap} - pmod({gap}, {DAY_MICROS})) div {DAY_MICROS}"


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two times, floored: -23 h is -1, not 0."""
    return floor_div(micros(later) - micros(earlier), DAY_MICROS)


def days_before(ts: Column, days: int) -> Column:
    return ts - F.expr(f"INTERVAL '{int(days)}' DAY")


def time_literal(value: datetime | str, like: str = "timestamp_ntz") -> Column:
    """Literal of the column's own type, so that comparisons need no cast of the column
    and still reach the Parquet reader."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast(like)


def column_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def max_time(df: DataFrame, ts: str) -> datetime:
    """Latest time of a table: one row to the driver."""
    row = df.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("m")).first()
    if row is None or row["m"] is None:
        raise ValueError(f"no rows to take the latest {ts} from")
    return row["m"]


def reference_date(df: DataFrame, ts: str = "InvoiceDate", days: int = 0) -> datetime:
    return max_time(df, ts) - timedelta(days=days)


def parse_ts(text: Column, fmt: str | None = None, strict: bool = True) -> Column:
    """Parse a string column; ``strict=False`` gives NULL for text that is no date."""
    args = (text,) if fmt is None else (text, F.lit(fmt))
    return F.to_timestamp(text, fmt) if strict else F.try_to_timestamp(*args)
