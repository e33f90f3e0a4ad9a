"""Splits, folds and class balance. All draws are repeatable (see functions.draws)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trolley.functions.draws import DRAW_RANGE, draw, draw_order
from trolley.operators.ordering import number_rows


def split(df: DataFrame, frac: float, seed: int, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(train, validation) by a draw on the key; ``frac`` goes to validation."""
    chosen = draw(seed, *[F.col(k) for k in key]) < int(frac * DRAW_RANGE)
    return df.filter(~chosen), df.filter(chosen)


def chunk_users(df: DataFrame, n: int, seed: int, key: str = "customer_id", name: str = "chunk") -> DataFrame:
    """n random, near-equal chunks of customers without a shuffle."""
    return df.withColumn(name, F.pmod(draw(seed, F.col(key)), F.lit(n)))


def shuffle(df: DataFrame, seed: int, key: Sequence[str]) -> DataFrame:
    return df.orderBy(draw_order(seed, *[F.col(k) for k in key]), *key)


def kfold(df: DataFrame, k: int, order: Sequence[Column], name: str = "fold") -> DataFrame:
    """Contiguous folds in the given order; the first (n mod k) folds hold one row more."""
    numbered = number_rows(df, order, "_no", 0)
    n = numbered.count()
    size, larger = divmod(n, k)
    edge = larger * (size + 1)
    place = F.col("_no")
    early = F.floor(place / F.lit(size + 1))
    late = F.lit(larger) + F.floor((place - edge) / F.lit(max(size, 1)))
    return numbered.withColumn(name, F.when(place < edge, early).otherwise(late).cast("long")).drop("_no")


def head_split(df: DataFrame, n: int, order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """The first n rows in the given order, and the rest."""
    numbered = number_rows(df, order, "_no", 0)
    return numbered.filter(F.col("_no") < n).drop("_no"), numbered.filter(F.col("_no") >= n).drop("_no")


def undersample(df: DataFrame, label: str, seed: int, key: Sequence[str]) -> DataFrame:
    """Reduce the larger class of a 0/1 label to the exact size of the smaller one."""
    sizes = {int(r[label]): r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    large, small = (0, 1) if sizes.get(0, 0) >= sizes.get(1, 0) else (1, 0)
    drawn = df.filter(F.col(label) == large).withColumn("_d", draw_order(seed, *[F.col(c) for c in key]))
    kept = number_rows(drawn, [F.asc("_d"), *[F.asc(c) for c in key]], "_no").filter(F.col("_no") <= sizes.get(small, 0))
    return kept.select(*df.columns).unionByName(df.filter(F.col(label) == small))


def class_weights(df: DataFrame, targets: Sequence[str], mu: float = 0.15) -> DataFrame:
    """max(1, ln(mu * total / count)) per target, from the positives of each target column."""
    sums = df.agg(*[F.sum(F.col(f"`{t}`")).cast("double").alias(t) for t in targets])
    total = sum((F.col(f"`{t}`") for t in targets), F.lit(0.0))
    totals = sums.select(F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"`{t}`").alias("count")) for t in targets]).alias("c"),
                         total.alias("total"))
    score = F.log(F.lit(mu) * F.col("total") / F.when(F.col("e.count") == 0, 1.0).otherwise(F.col("e.count")))
    return totals.select(F.explode("c").alias("e"), "total").select(
        F.col("e.target").alias("target"), F.greatest(F.lit(1.0), F.coalesce(score, F.lit(1.0))).alias("weight"))
