"""Training and scoring universes: features, labels and item lists as of reference dates.

All universes of a run are built in one job: the universe number (``origin``) is part of
every key, and a transaction row is copied only into the universes it belongs to. The copies
feed half a dozen aggregates, so they are stored once instead of being joined up again by each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window as W, functions as F

from trolley.functions.dates import column_type, reference_date, time_literal
from trolley.functions.text import tag
from trolley.operators.filters import only_items, restrict_to
from trolley.operators.gaps import gap_stats
from trolley.operators.reshape import assemble_customer, attach_labels, attach_long_labels, labels, labels_long, widen
from trolley.operators.recommend import score_grid
from trolley.operators.rfm import (CUSTOMER, PAIR, PENALTY, WINDOWS, WINDOWS_LONG, dated, recency, recency_features, span_days,
                                   span_feature, window_features, with_net_price)
from trolley.operators.sequences import sequence_steps
from trolley.operators.summary import top_item, top_n
from trolley.session import materialise

ORIGIN = "origin"


@dataclass(frozen=True)
class Universe:
    """Model-ready ``rows``; ``items`` are the purchases behind them (for TF-IDF and sequences).

    ``labelled`` holds the keys of the documents TF-IDF counts, also those without purchases.
    """

    rows: DataFrame
    items: DataFrame
    labelled: DataFrame | None = None


def feature_block(df: DataFrame, keys: Sequence[str], windows: Sequence[int], ref: datetime | None = None, prefix: str = "",
                  fill_before: bool = False, letter: str | None = None, span: str | None = None, **options) -> DataFrame:
    """Windowed aggregates, recency or span, and gap statistics of one key, back from ``ref``
    or from the rows' own ``rd``."""
    measures = window_features(windows, prefix, **options)
    if letter:
        measures += recency_features(letter)
    if span:
        measures.append(span_feature(span))
    return dated(df, ref).groupBy(*keys).agg(*measures).join(
        gap_stats(df, keys, fill_before=fill_before, prefix="C_" if prefix else ""), list(keys))


def _measures(block: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in block.columns if c not in keys]


def _filled(base: DataFrame, blocks: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return assemble_customer(base, blocks, keys).na.fill(PENALTY)


def universe_fixed(raw: DataFrame, targets: Sequence[str], horizon: int = 60, windows: Sequence[int] = WINDOWS,
                   fill_before: bool = True) -> Universe:
    """Features up to ``horizon`` days before the end, labels from the days after.

    Only labelled customers make rows, so the past of all others is dropped before any
    feature is computed; the other universes do the same.
    """
    ref = reference_date(raw, days=horizon)
    cut = time_literal(ref, column_type(raw, "InvoiceDate"))
    wanted = only_items(raw, targets)
    labelled = labels(wanted.filter(F.col("InvoiceDate") > cut), targets)
    base = labelled.select(*CUSTOMER)
    past = restrict_to(wanted.filter(F.col("InvoiceDate") <= cut), base)
    pairs = feature_block(past, PAIR, windows, ref, fill_before=fill_before, letter="R")
    wide = widen(pairs, targets, _measures(pairs, PAIR))
    rows = attach_labels(_filled(base, [wide, recency(past, ref, CUSTOMER, "T")], CUSTOMER), labelled)
    return Universe(rows, sequence_steps(restrict_to(raw.filter(F.col("InvoiceDate") <= cut), base), ref), base)


def score_universe_wide(raw: DataFrame, targets: Sequence[str], template: DataFrame, windows: Sequence[int] = WINDOWS,
                        fill_before: bool = True) -> Universe:
    """Features as of the last date for exactly the template's customers; customers without
    purchases get the penalty everywhere."""
    ref = reference_date(raw)
    past = restrict_to(only_items(raw, targets), template)
    pairs = feature_block(past, PAIR, windows, ref, fill_before=fill_before, letter="R")
    wide = widen(pairs, targets, _measures(pairs, PAIR))
    rows = _filled(template.select(*CUSTOMER), [wide, recency(past, ref, CUSTOMER, "T")], CUSTOMER)
    return Universe(rows, sequence_steps(restrict_to(raw, template), ref))


def origins(raw: DataFrame, n: int, step: int) -> list[tuple[int, datetime, datetime]]:
    """(origin, reference date, end) for n universes, each ending where the data up to the
    previous reference date really ends.

    One row per day reaches the driver; a day is looked into only if a reference date falls
    inside it before its last purchase.
    """
    days = [r["m"] for r in raw.groupBy(F.to_date("InvoiceDate").alias("d"))
            .agg(F.max(F.col("InvoiceDate").cast("timestamp_ntz")).alias("m")).orderBy("d").collect()]
    kind, out, limit = column_type(raw, "InvoiceDate"), [], None
    for origin in range(1, n + 1):
        known = [m for m in days if limit is None or m <= limit]
        if limit is not None and any(m.date() == limit.date() and m > limit for m in days):
            inside = raw.filter((F.col("InvoiceDate") <= time_literal(limit, kind))
                                & (F.to_date("InvoiceDate") == F.lit(limit.date())))
            latest = inside.agg(F.max(F.col("InvoiceDate").cast("timestamp_ntz")).alias("m")).first()["m"]
            known += [latest] if latest else []
        if not known:
            break
        end = max(known)
        limit = end - timedelta(days=step)
        out.append((origin, limit, end))
    return out


def rolling_blocks(past: DataFrame, targets: Sequence[str], windows: Sequence[int], keys: Sequence[str], ref: datetime | None = None) -> list[DataFrame]:
    """Wide pair block and customer block of a rolling universe, back from ``ref`` or the rows' own ``rd``."""
    kinds, pair = ("sum", "min", "max"), (*keys, "item_id")
    pairs = feature_block(past, pair, windows, ref, letter="R", amount=kinds, quantity=kinds)
    wide = widen(pairs, targets, _measures(pairs, pair), keys)
    return [wide, feature_block(past, keys, windows, ref, prefix="C", letter="T", amount=kinds, quantity=kinds, sep="_")]


def universe_rolling(raw: DataFrame, targets: Sequence[str], n: int = 6, step: int = 30,
                     windows: Sequence[int] = WINDOWS_LONG) -> Universe:
    """n stacked universes, ``step`` days apart: RFM with sum/min/max on pair and customer level,
    recencies, gaps and 0/1 labels from the ``step`` days after each reference date."""
    kind = column_type(raw, "InvoiceDate")
    spans = F.array(*[F.struct(F.lit(o).cast("long").alias(ORIGIN), time_literal(rd, kind).alias("rd"),
                               time_literal(end, kind).alias("end")) for o, rd, end in origins(raw, n, step)])
    wanted = only_items(raw, targets)
    copies = wanted.withColumn("_o", F.explode(F.filter(spans, lambda s: F.col("InvoiceDate") <= s["end"])))
    copies = copies.select(*wanted.columns, f"_o.{ORIGIN}", "_o.rd")
    keys = (ORIGIN, *CUSTOMER)
    labelled = labels(copies.filter(F.col("InvoiceDate") > F.col("rd")), targets, keys)
    past = materialise(restrict_to(copies.filter(F.col("InvoiceDate") <= F.col("rd")), labelled, keys), "past")
    rows = attach_labels(_filled(labelled.select(*keys), rolling_blocks(past, targets, windows, keys), keys), labelled, keys)
    return Universe(rows, past.select(*keys, tag("ITEM_", F.col("item_id")).alias("item")), labelled.select(*keys))


def popular_by_origin(raw: DataFrame, n: int, step: int, popular: int) -> DataFrame:
    """The most frequent items of each rolling universe: (origin, item_id, count)."""
    kind = column_type(raw, "InvoiceDate")
    ends = F.array(*[F.struct(F.lit(o).cast("long").alias(ORIGIN), time_literal(end, kind).alias("end"))
                     for o, _, end in origins(raw, n, step)])
    copies = raw.select("item_id", F.explode(F.filter(ends, lambda s: F.col("InvoiceDate") <= s["end"])).alias("_o"))
    counts = copies.groupBy(F.col(f"_o.{ORIGIN}").alias(ORIGIN), "item_id").agg(F.count(F.lit(1)).alias("count"))
    return top_n(counts, [ORIGIN], "count", popular, ["item_id"])


def gap_blocks(past: DataFrame, items: Sequence[str], keys: Sequence[str]) -> list[DataFrame]:
    """Wide gap statistics of the listed items."""
    pair = (*keys, "item_id")
    gaps = gap_stats(past.filter(F.col("item_id").isin(*items)), pair)
    return [widen(gaps, items, _measures(gaps, pair), keys)]


def universe_gaps(raw: DataFrame, targets: Sequence[str], n: int = 6, step: int = 30, popular: int = 30) -> Universe:
    """Rolling universes of gap statistics and item lists over the targets and each universe's
    most popular items; gap columns are kept for items present in every universe."""
    kind = column_type(raw, "InvoiceDate")
    dates = origins(raw, n, step)
    extra = popular_by_origin(raw, n, step, popular).select(ORIGIN, "item_id").collect()  # n * popular rows
    lists = {o: set(targets) | {r["item_id"] for r in extra if r[ORIGIN] == o} for o, _, _ in dates}
    common = sorted(set.intersection(*lists.values())) if lists else []
    spans = F.array(*[F.struct(
        F.lit(o).cast("long").alias(ORIGIN), time_literal(rd, kind).alias("rd"), time_literal(end, kind).alias("end"),
        F.array(*[F.lit(i) for i in sorted(lists[o])]).alias("items")) for o, rd, end in dates])
    copies = raw.withColumn("_o", F.explode(F.filter(spans, lambda s: (F.col("InvoiceDate") <= s["end"])
                                                     & F.array_contains(s["items"], F.col("item_id")))))
    copies = copies.select(*raw.columns, f"_o.{ORIGIN}", "_o.rd")
    keys = (ORIGIN, *CUSTOMER)
    labelled = labels(copies.filter(F.col("InvoiceDate") > F.col("rd")), targets, keys)
    past = restrict_to(copies.filter(F.col("InvoiceDate") <= F.col("rd")), labelled, keys)
    base = past.select(*keys).distinct()
    rows = attach_labels(_filled(base, gap_blocks(past, common, keys), keys), labelled, keys)
    return Universe(rows, past.select(*keys, F.col("item_id").alias("item")), base)


def newest_visits(raw: DataFrame, n: int) -> DataFrame:
    """Per customer the n newest distinct visit times, newest first (limited before the shuffle)."""
    visits = raw.select(*CUSTOMER, "InvoiceDate").distinct()
    newest = W.partitionBy(*CUSTOMER).orderBy(F.desc("InvoiceDate"))
    top = visits.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n)
    return top.groupBy(*CUSTOMER).agg(F.sort_array(F.collect_list("InvoiceDate"), asc=False).alias("visits"))


def last_visit_blocks(past: DataFrame, targets: Sequence[str], windows: Sequence[int], keys: Sequence[str]) -> list[DataFrame]:
    """Wide pair block and customer block of a last-visit universe, back from the rows' own ``rd``."""
    pair = (*keys, "item_id")
    pairs = feature_block(past, pair, windows, span="R_F", amount=("mean",))
    wide = widen(pairs, targets, _measures(pairs, pair), keys)
    return [wide, feature_block(past, keys, windows, prefix="C", span="T_F", amount=("mean",))]


def universe_last_visit(raw: DataFrame, targets: Sequence[str], n: int = 4,
                        windows: Sequence[int] = WINDOWS_LONG) -> Universe:
    """Universe p drops each customer's p-1 newest visits (any item), labels from the newest
    remaining visit with a target item, features from the target purchases before it, dated
    back from the customer's own latest feature date."""
    wanted = only_items(raw, targets)
    cuts = newest_visits(raw, max(n - 1, 1))
    dates = (wanted.select(*CUSTOMER, "InvoiceDate").distinct().join(cuts, list(CUSTOMER))
             .withColumn(ORIGIN, F.explode(F.sequence(F.lit(1), F.lit(n))))
             .filter((F.col(ORIGIN) == 1) | (F.col("InvoiceDate") < F.get("visits", F.col(ORIGIN) - 2))))
    newest = W.partitionBy(*CUSTOMER, ORIGIN).orderBy(F.desc("InvoiceDate"))
    two = dates.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= 2)
    spans = (two.groupBy(*CUSTOMER, F.col(ORIGIN).cast("long").alias(ORIGIN)).agg(
        F.max("InvoiceDate").alias("label_date"),
        F.max(F.when(F.col("_rn") == 2, F.col("InvoiceDate"))).alias("rd"))
        .groupBy(*CUSTOMER).agg(F.collect_list(F.struct(ORIGIN, "label_date", "rd")).alias("_s")))
    copies = (wanted.join(spans, list(CUSTOMER))
              .withColumn("_o", F.explode(F.filter("_s", lambda s: F.col("InvoiceDate") <= s["label_date"])))
              .select(*wanted.columns, f"_o.{ORIGIN}", "_o.label_date", "_o.rd"))
    copies = materialise(copies, "copies")
    past = copies.filter(F.col("InvoiceDate") < F.col("label_date"))  # every customer here has a labelled visit
    keys = (ORIGIN, *CUSTOMER)
    labelled = labels(copies.filter(F.col("InvoiceDate") == F.col("label_date")), targets, keys)
    rows = attach_labels(_filled(labelled.select(*keys), last_visit_blocks(past, targets, windows, keys), keys), labelled, keys)
    return Universe(rows, past.select(*keys, tag("ITEM_", F.col("item_id")).alias("item")), labelled.select(*keys))


def _long_blocks(past: DataFrame, targets: Sequence[str], keys: Sequence[str], windows: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """(pair block on target items, customer block on all items plus target-item span and IMPP).

    ``past`` carries the customer's reference date ``rd``; the pair block has its own one,
    the customer's latest target purchase.
    """
    pair = (*keys, "item_id")
    past = with_net_price(past)
    wanted = only_items(past, targets).drop("rd")
    latest = wanted.groupBy(*keys).agg(F.max("InvoiceDate").alias("rd"))
    pairs = feature_block(wanted.join(latest, list(keys)), pair, windows, span="R_F", net=True)
    customers = feature_block(past, keys, windows, prefix="C", amount=("mean",), net=True)
    block = (customers.join(span_days(wanted, keys, "T_F"), list(keys), "left")
             .join(top_item(past, keys), list(keys), "left"))
    return pairs, block


def universe_long(raw: DataFrame, targets: Sequence[str], n: int = 6, windows: Sequence[int] = WINDOWS_LONG) -> Universe:
    """One row per (customer, target item): universe p is labelled by the customer's p-th newest
    visit (any item; positive quantities only) and described by everything before it."""
    keys, pair = (ORIGIN, *CUSTOMER), (ORIGIN, *PAIR)
    places = F.transform("visits", lambda v, i: F.struct(
        (i + 1).cast("long").alias(ORIGIN), v.alias("label_date"), F.get("visits", i + 1).alias("rd")))
    spans = newest_visits(raw, n + 1).select(*CUSTOMER, F.filter(places, lambda s: s[ORIGIN] <= n).alias("_s"))
    copies = (raw.join(spans, list(CUSTOMER))
              .withColumn("_o", F.explode(F.filter("_s", lambda s: F.col("InvoiceDate") <= s["label_date"])))
              .select(*raw.columns, f"_o.{ORIGIN}", "_o.label_date", "_o.rd"))
    bought = copies.filter((F.col("InvoiceDate") == F.col("label_date")) & (F.col("item_qty") > 0))
    labelled = labels_long(bought, targets, keys)
    past = materialise(restrict_to(copies.filter(F.col("InvoiceDate") < F.col("label_date")).drop("label_date"),
                                   bought.filter(F.col("item_id").isin(*targets)), keys), "past")
    pairs, block = _long_blocks(past, targets, keys, windows)
    rows = attach_long_labels(pairs, labelled, pair).join(block, list(keys), "left").na.fill(PENALTY).na.fill(str(PENALTY))
    return Universe(rows, past.select(*keys, "InvoiceDate", "item_id", "item_qty", "item_amt"), labelled.select(*keys).distinct())


def score_universe(raw: DataFrame, targets: Sequence[str], windows: Sequence[int] = WINDOWS_LONG) -> Universe:
    """Scoring grid of the long universe: customers with a target purchase x target items seen."""
    wanted = only_items(raw, targets)
    seen = sorted(r["item_id"] for r in wanted.select("item_id").distinct().collect())  # at most the target list
    latest = raw.groupBy(*CUSTOMER).agg(F.max("InvoiceDate").alias("rd"))
    pairs, block = _long_blocks(raw.join(latest, list(CUSTOMER)), targets, CUSTOMER, windows)
    grid = score_grid(pairs.select(*CUSTOMER).distinct(), seen)
    rows = (grid.join(pairs, list(PAIR), "left").join(block, list(CUSTOMER), "left")
            .na.fill(PENALTY).na.fill(str(PENALTY)))
    return Universe(rows, raw.select(*CUSTOMER, "InvoiceDate", "item_id", "item_qty", "item_amt"))
