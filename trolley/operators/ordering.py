"""Row numbers, running sums and positions without one big task.

Two situations need an order at scale:

* an order over the *whole* table (dense ids, folds, exact AUC): range-partition, number
  inside each partition, add the partition's start. The starts are one row per partition.
* an order *within a key* (lags, visit ranks, sequences), where one key may own a third of
  the rows: ordinary keys take one window; keys beyond HOT_ROWS are numbered in one order over
  all their rows, so a hot key, a burst of equal times and a missing key are spread like any rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from trolley.session import materialise

# A key with more rows than this is ordered by range partitions instead of a window.
HOT_ROWS = 1_000_000
# Longest list of hot keys that is broadcast; a longer one is joined by shuffling.
BROADCAST_KEYS = 100_000

_SLOT_BITS = 33  # monotonically_increasing_id keeps the partition above bit 33


def _range_parts(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    slotted = (df.repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_slot", F.monotonically_increasing_id()))
    return (materialise(slotted, "ordered")
            .withColumn("_part", F.shiftright("_slot", _SLOT_BITS)))


def _starts(totals: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exclusive running totals over the partitions: at most one row per partition."""
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("_part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_start_{n}")
                                    for n in names])


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_no", first: int = 1) -> DataFrame:
    """Contiguous numbers in a total order (the order columns must be unique together)."""
    parts = _range_parts(df, order)
    starts = _starts(parts.groupBy("_part").agg(F.count(F.lit(1)).alias("n")), ["n"])
    place = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return (parts.join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start_n") + place + F.lit(first))
            .drop("_part", "_slot", "_start_n"))


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """Add, for each ``value -> name``, the sum of ``value`` over all earlier rows."""
    parts = _range_parts(df, order)
    values = list(sums)
    starts = _starts(parts.groupBy("_part").agg(*[F.sum(v).alias(v) for v in values]), values)
    earlier = W.partitionBy("_part").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    inside = parts.select("*", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_in_{v}") for v in values])
    return (inside.join(F.broadcast(starts), "_part")
            .select(*df.columns, *[(F.col(f"_start_{v}") + F.col(f"_in_{v}")).alias(n) for v, n in sums.items()]))


def joined_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys equal each other, as they do in a window or an aggregate."""
    named = right.select(*[F.col(f"`{k}`").alias(f"_jk{i}") for i, k in enumerate(keys)], *[F.col(f"`{c}`") for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(named[f"_jk{i}"]) for i, k in enumerate(keys)])
    return left.join(named, same, how).drop(*[f"_jk{i}" for i in range(len(keys))])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The stored keys that more than one row has, or None; a short list is marked for broadcasting."""
    more = materialise(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*keys), "hot")
    n = more.count()
    return None if n == 0 else F.broadcast(more) if n <= BROADCAST_KEYS else more


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of keys with more than ``hot_rows`` rows, or None).

    One partially aggregated count finds the hot keys; their stored list is broadcast only if
    it is short.
    """
    hot = materialise(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*keys), "hot")
    n = hot.count()
    if n == 0:
        return df, None
    listed = F.broadcast(hot) if n <= BROADCAST_KEYS else hot
    return joined_on(df, listed, keys, "left_anti"), joined_on(df, listed, keys, "left_semi")


def position_in_key(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[Column] = (), newest_first: bool = True,
                    name: str = "position", hot_rows: int = HOT_ROWS) -> DataFrame:
    """1-based position of each row within its key, ordered by time then ``ties``; rows without a
    time come last (first in ascending order), rows without a key are one group."""
    keys = list(keys)
    by_time = F.col(ts).desc() if newest_first else F.col(ts).asc()
    ordinary, hot = split_hot(df, keys, hot_rows)
    direct = ordinary.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(by_time, *ties)).cast("long"))
    if hot is None:
        return direct

    # All hot rows are numbered in one range-partitioned order; a key's positions are its numbers less
    # its first one. The draw spreads rows that are equal in everything else.
    numbered = number_rows(hot.withColumn("_draw", F.rand(0)), [*[F.asc(k) for k in keys], by_time, *ties, F.asc("_draw")], "_no").drop("_draw")
    firsts = numbered.groupBy(*keys).agg(F.min("_no").alias("_first"))
    placed = joined_on(numbered, firsts, keys).withColumn(name, F.col("_no") - F.col("_first") + 1)
    return direct.select(*df.columns, name).unionByName(placed.select(*df.columns, name))


def prior_times(df: DataFrame, keys: Sequence[str], ts: str, depth: int = 3, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per (key, time) with its row count ``rows`` and ``prior``, the times of up to
    ``depth`` rows just before it (newest first, repeated where a time holds several rows).
    Rows without a time have no place in the order and are left out."""
    keys = list(keys)
    empty = F.array().cast(f"array<{df.schema[ts].dataType.simpleString()}>")

    def collapsed(rows: DataFrame) -> DataFrame:
        return (rows.filter(F.col(ts).isNotNull()).groupBy(*keys, F.col(ts).alias("_ts"))
                .agg(F.count(F.lit(1)).alias("rows")))

    def repeated(when: Column, count: Column) -> Column:
        times = F.array_repeat(when, F.least(count, F.lit(depth)).cast("int"))
        return F.when(when.isNull(), empty).otherwise(times)

    def preceding(over: WindowSpec) -> Column:
        earlier = [repeated(F.lag("_ts", i).over(over), F.lag("rows", i).over(over)) for i in range(1, depth + 1)]
        return F.slice(F.concat(*earlier), 1, depth)

    columns = [*keys, F.col("_ts").alias(ts), "rows", "prior"]
    ordinary, hot = split_hot(df, keys, hot_rows)
    direct = (collapsed(ordinary).select("*", preceding(W.partitionBy(*keys).orderBy("_ts")).alias("prior"))
              .select(*columns))
    if hot is None:
        return direct

    # Hot keys: times numbered in one order over the table; the i-th time before is the row i numbers less.
    numbered = materialise(number_rows(collapsed(hot), [*[F.asc(k) for k in keys], F.asc("_ts")], "_no"), "times")
    joined, earlier = numbered, []
    for i in range(1, depth + 1):
        before = numbered.select((F.col("_no") + i).alias("_no"), F.struct(*[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)], "_ts", "rows").alias(f"_before{i}"))
        joined = joined.join(before, "_no", "left")
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_before{i}.k{n}")) for n, k in enumerate(keys)])
        earlier.append(repeated(F.when(same, F.col(f"_before{i}._ts")), F.col(f"_before{i}.rows")))
    return direct.unionByName(joined.withColumn("prior", F.slice(F.concat(*earlier), 1, depth)).select(*columns))


def dense_rank_in_key(df: DataFrame, keys: Sequence[str], value: str, descending: bool = True,
                      name: str = "rank") -> DataFrame:
    """Dense rank of a value within its key, for keys of any size.

    The distinct (key, value) pairs are numbered over the whole table; a key's ranks are its
    numbers less its first one.
    """
    keys = list(keys)
    order = [F.col(k) for k in keys] + [F.col(value).desc() if descending else F.col(value).asc()]
    numbered = number_rows(df.select(*keys, value).distinct(), order, "_no")
    firsts = numbered.groupBy(*keys).agg(F.min("_no").alias("_first"))
    ranks = joined_on(numbered, firsts, keys).select(*keys, value, (F.col("_no") - F.col("_first") + 1).alias(name))
    return joined_on(df, ranks, [*keys, value])


def forward_fill(df: DataFrame, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Replace NULL by the closest earlier value in a total order over the whole table."""
    parts = _range_parts(df, order)
    ends = parts.groupBy("_part").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_slot"))).alias(c) for c in columns])
    earlier_parts = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select("_part", *[F.last(c, True).over(earlier_parts).alias(f"_carry_{c}") for c in columns])
    so_far = W.partitionBy("_part").orderBy("_slot").rowsBetween(W.unboundedPreceding, 0)
    filled = parts.select(
        *[F.last(c, True).over(so_far).alias(c) if c in columns else F.col(c) for c in parts.columns])
    return (filled.join(F.broadcast(carried), "_part")
            .select(*[F.coalesce(F.col(c), F.col(f"_carry_{c}")).alias(c) if c in columns else F.col(c)
                      for c in df.columns]))
