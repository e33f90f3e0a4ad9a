"""Days between a purchase and the ones before it.

The input is read more than once (hot keys are looked for first): store an expensive join
before handing it over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from trolley.functions.dates import floor_days, floor_days_text
from trolley.operators.ordering import HOT_ROWS, prior_times
from trolley.operators.rfm import PAIR, PENALTY


def lags(df: DataFrame, keys: Sequence[str] = PAIR, n: int = 3, ts: str = "InvoiceDate", hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per purchase with the dates of its 1..n predecessors and the day gaps.

    Purchases of one key at the same time follow each other in any order: only times are
    lagged, so the result does not depend on it.
    """
    steps = (prior_times(df, keys, ts, n, hot_rows=hot_rows)
             .withColumn("_r", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))))
    out = [*keys, ts]
    for lag in range(1, n + 1):
        before = F.when(F.col("_r") > lag, F.col(ts)).otherwise(
            F.get("prior", (F.lit(lag) - F.col("_r")).cast("int")))
        out += [before.alias(f"lag{lag}"), floor_days(F.col(ts), before).alias(f"gap{lag}")]
    return steps.select(*out)


def _mean_std(lag: int, fill_before: bool, stem: str) -> list[str]:
    """Mean and sample deviation from integer sums, in decimals so that nothing cancels."""
    count, total, squares = (f"_{name}{lag}" for name in "nsq")
    if fill_before:
        count, total = f"({count} + _m{lag})", f"({total} + _m{lag} * {PENALTY})"
        squares = f"({squares} + _m{lag} * {PENALTY * PENALTY})"
    n, s, q = (f"CAST({x} AS DECIMAL(38,0))" for x in (count, total, squares))
    spread = f"CAST({n} * {q} - {s} * {s} AS DOUBLE)"
    return [f"CASE WHEN {count} > 0 THEN {total} / {count} END AS {stem}Mean",
            f"CASE WHEN {count} > 1 THEN sqrt({spread} / (CAST({count} AS DOUBLE) * ({count} - 1))) END AS {stem}Std"]


def gap_stats(df: DataFrame, keys: Sequence[str] = PAIR, n: int = 3, fill_before: bool = False,
              prefix: str = "", ts: str = "InvoiceDate", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mean and sample deviation of the 1..n-step gaps.

    ``fill_before=True`` counts a missing gap as the penalty inside the statistics;
    otherwise it is left out and an undefined statistic stays NULL.
    """
    steps = prior_times(df, keys, ts, n, hot_rows=hot_rows).selectExpr(
        *keys, "rows", *[floor_days_text(ts, f"get(prior, {i - 1})") + f" AS _d{i}" for i in range(1, n + 1)])
    sums = []
    for lag in range(1, n + 1):
        # The r-th of `rows` purchases made at one time looks lag-r+1 purchases behind that time;
        # purchases beyond the lag-th look at the same time, a gap of 0.
        used = [(f"rows >= {lag - i + 1}", f"_d{i}") for i in range(1, lag + 1)]
        terms = {
            "n": [f"greatest(rows - {lag}, 0L)"] + [f"CASE WHEN {u} AND {d} IS NOT NULL THEN 1L ELSE 0L END" for u, d in used],
            "s": [f"CASE WHEN {u} THEN coalesce({d}, 0L) ELSE 0L END" for u, d in used],
            "q": [f"CASE WHEN {u} THEN coalesce({d} * {d}, 0L) ELSE 0L END" for u, d in used],
            "m": [f"CASE WHEN {u} AND {d} IS NULL THEN 1L ELSE 0L END" for u, d in used]}
        sums += [F.expr(f"sum({' + '.join(parts)}) AS _{name}{lag}") for name, parts in terms.items()]
    stats = [text for lag in range(1, n + 1) for text in _mean_std(lag, fill_before, f"{prefix}DayDiff{'' if lag == 1 else lag}")]
    return steps.groupBy(*keys).agg(*sums).selectExpr(*keys, *stats)
