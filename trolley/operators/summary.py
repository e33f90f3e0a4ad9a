"""Counts, dictionaries, profiles and per-key picks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from trolley.functions.columns import log_shift
from trolley.operators.ordering import HOT_ROWS, joined_on, number_rows, position_in_key, running_sums
from trolley.operators.rfm import CUSTOMER, PAIR


def popular_items(df: DataFrame, n: int, item: str = "item_id") -> DataFrame:
    """The n most frequent items with their counts (n is a report size; ties by item)."""
    return (df.groupBy(item).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(item)).limit(n))


def popularity_index(df: DataFrame, column: str, name: str = "index") -> DataFrame:
    """Dictionary value -> 1-based popularity rank."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return number_rows(counts, [F.desc("_n"), F.asc(column)], name).select(column, name)


def encode_ids(df: DataFrame, column: str, name: str = "id") -> DataFrame:
    """Dictionary value -> contiguous 0-based id in value order."""
    return number_rows(df.select(column).filter(F.col(column).isNotNull()).distinct(), [F.asc(column)], name, 0)


def group_mode(df: DataFrame, key: str, column: str, name: str = "mode") -> DataFrame:
    """Most frequent value per key, the smallest on a tie."""
    counts = (df.filter(F.col(column).isNotNull()).groupBy(key, column)
              .agg(F.count(F.lit(1)).alias("_n")))
    return counts.groupBy(key).agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(name))


def top_item(df: DataFrame, keys: Sequence[str] = CUSTOMER) -> DataFrame:
    """Most purchased item per customer (IMPP) and how often; the smallest item on a tie."""
    counts = df.groupBy(*keys, "item_id").agg(F.count("transaction_id").alias("_n"))
    return counts.groupBy(*keys).agg(
        F.min_by("item_id", F.struct(-F.col("_n"), F.col("item_id"))).alias("IMPP"),
        F.max("_n").alias("IMPP_count"))


def implicit_rating(df: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """ln(1 + number of invoice rows) per pair."""
    return df.groupBy(*keys).agg(log_shift(F.count("transaction_id"), 1.0).alias("rating"))


def n_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


def bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"))


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def base_rates(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(F.col(f"`{t}`")).alias(t) for t in targets])


def quantiles(df: DataFrame, column: str, at: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: one row (q, value) per entry of ``at``.

    Equal values are counted first, then numbered by running sums over a range-partitioned
    order; only the rows around the wanted ranks are kept.
    """
    counts = (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v"))
              .agg(F.count(F.lit(1)).alias("n")))
    placed = running_sums(counts, [F.asc("v")], {"n": "before"})
    total = placed.agg(F.max(F.col("before") + F.col("n")).alias("t")).first()["t"] or 0
    rows = []
    for q in at:
        spot = (total - 1) * q
        low = int(spot)
        for rank, weight in ((low, 1.0 - (spot - low)), (low + 1, spot - low)):
            rows.append(F.struct(F.lit(float(q)).alias("q"), F.lit(rank).cast("long").alias("rank"),
                                 F.lit(float(weight)).alias("w")))
    wanted = placed.select("v", "n", "before", F.explode(F.array(*rows)).alias("want"))
    hits = wanted.filter((F.col("want.rank") >= F.col("before")) & (F.col("want.rank") < F.col("before") + F.col("n")))
    return hits.groupBy(F.col("want.q").alias("q")).agg(F.sum(F.col("v") * F.col("want.w")).alias("value"))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column."""
    out = []
    for column in columns:
        marks = {r["q"]: r["value"] for r in quantiles(df, column, (0.25, 0.5, 0.75)).collect()}
        out.append(df.agg(
            F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
            F.min(column).cast("double").alias("min"), F.max(column).cast("double").alias("max"))
            .select(F.lit(column).alias("column"), "*", *[
                F.lit(marks.get(q)).cast("double").alias(n) for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]))
    return reduce(DataFrame.unionByName, out)


def visit_rank(df: DataFrame, keys: Sequence[str] = CUSTOMER, ts: str = "InvoiceDate", name: str = "rank",
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Dense rank of the visit time within the customer, newest = 1, on every row."""
    visits = df.select(*keys, ts).distinct()
    return joined_on(df, position_in_key(visits, keys, ts, name=name, hot_rows=hot_rows), [*keys, ts])


def top_n(df: DataFrame, keys: Sequence[str], score: str, n: int, ties: Sequence[str], rank: str | None = None) -> DataFrame:
    """The n best rows per key. The row limit is applied before the shuffle as well, so a hot
    key sends at most n rows per task; ``rank`` adds the dense rank within those n."""
    best = W.partitionBy(*keys).orderBy(F.desc(score), *[F.asc(t) for t in ties])
    kept = df.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= n).drop("_rn")
    if rank is None:
        return kept
    return kept.withColumn(rank, F.dense_rank().over(W.partitionBy(*keys).orderBy(F.desc(score))).cast("long"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key, the first in the given total order (a partial aggregate)."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
            .select(*keys, "_row.*").select(*df.columns))


def dedup_features(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """Drop rows that equal another one in everything but the excluded key; keeps the smallest key."""
    same = [F.col(f"`{c}`") for c in df.columns if c not in exclude]
    return df.groupBy(*same).agg(*[F.min(c).alias(c) for c in exclude]).select(*[F.col(f"`{c}`") for c in df.columns])

