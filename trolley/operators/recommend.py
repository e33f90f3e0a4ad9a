"""Scores from weight tables, filters on them, and ranked lists.

Profiles are long triples ``(user, item, value)``; weights are ``(item_from, item_to,
weight)``. Scores and lists stay long: an excluded item is an absent row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from trolley.functions.columns import log_shift
from trolley.operators.filters import in_scope, min_activity, valid_keys
from trolley.operators.summary import popular_items, popularity_index, top_n
from trolley.session import materialise

# The intercept pseudo-item, its value, and the shift of the logarithm.
INTERCEPT = 9999
INTERCEPT_VALUE = 1
LOG_SHIFT = 0.1
# Longest list of weights that is broadcast.
BROADCAST_WEIGHTS = 100_000


def add_intercept(df: DataFrame, user: str = "user", item: str = "item", value: str = "value") -> DataFrame:
    """One more row per user for the intercept pseudo-item."""
    kind, amount = df.schema[item].dataType, df.schema[value].dataType
    extra = df.select(user).distinct().select(
        user, F.lit(INTERCEPT).cast(kind).alias(item), F.lit(INTERCEPT_VALUE).cast(amount).alias(value))
    return df.select(user, item, value).unionByName(extra)


def build_urm(df: DataFrame, user: str = "user", item: str = "item", value: str = "value") -> DataFrame:
    """Sum of ln(value + 0.1) per (user, item): duplicates add up after the logarithm."""
    logged = df.select(user, item, log_shift(F.col(value), LOG_SHIFT).alias(value)).filter(F.col(value).isNotNull())
    return logged.groupBy(user, item).agg(F.sum(value).alias(value))


def slim_prepare(df: DataFrame, user: str = "user", item: str = "item", value: str = "value",
                 min_rows: int = 15) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(training triples, all encoded triples with intercept, item dictionary).

    Invalid users are dropped, items become popularity ranks, every user gets the intercept
    item, and only users with more than ``min_rows`` rows (intercept included) are trained on.
    """
    valid = valid_keys(df.select(user, item, value), user)
    index = popularity_index(valid, item, "index")
    encoded = valid.join(index, item).select(user, F.col("index").alias(item), value)
    everyone = add_intercept(encoded, user, item, value)
    return build_urm(min_activity(everyone, min_rows, [user]), user, item, value), everyone, index


def topk_weights(weights: DataFrame, k: int) -> DataFrame:
    """The k largest non-zero weights into each item (neighbour pruning)."""
    return top_n(weights.filter(F.col("weight") != 0), ["item_to"], "weight", k, ["item_from"])


def score_items(profiles: DataFrame, weights: DataFrame) -> DataFrame:
    """Sparse product of user profiles and item weights. A short list of weights (stored and counted) goes to all
    tasks, and only the profiles are shuffled, by user; a user has a cell for each item of such a list at most."""
    weights = materialise(weights.select("item_from", "item_to", "weight"), "weights")
    if weights.count() <= BROADCAST_WEIGHTS:
        profiles = profiles.join(F.broadcast(weights.select(F.col("item_from").alias("item")).distinct()), "item", "left_semi").repartition("user")
        weights = F.broadcast(weights)
    return (profiles.join(weights, profiles["item"] == weights["item_from"])
            .groupBy("user", F.col("item_to").alias("item"))
            .agg(F.sum(F.col("value") * F.col("weight")).alias("score")))


def score_item_based(urm: DataFrame, weights: DataFrame, users: DataFrame | None = None) -> DataFrame:
    profiles = urm if users is None else urm.join(users.select("user"), "user", "left_semi")
    return score_items(profiles, weights)


def score_user_based(urm: DataFrame, weights: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Product of user-user weights ``(user_from, user_to, weight)`` and the neighbours' profiles."""
    chosen = weights if users is None else weights.join(users.select(F.col("user").alias("user_from")), "user_from", "left_semi")
    neighbours = urm.select(F.col("user").alias("user_to"), "item", "value")
    return (chosen.join(neighbours, "user_to").groupBy(F.col("user_from").alias("user"), "item")
            .agg(F.sum(F.col("weight") * F.col("value")).alias("score")))


def slim_score(users: DataFrame, weights: DataFrame, index: DataFrame, trained_items: DataFrame) -> DataFrame:
    """Scores of all users over in-scope items, zeros and the intercept dropped, items decoded."""
    profiles = build_urm(in_scope(users, trained_items, "item"))
    scores = score_items(profiles, weights).filter((F.col("score") != 0) & (F.col("item") != INTERCEPT))
    names = index.toDF("code", "index")
    return scores.join(names, scores["item"] == names["index"]).select("user", F.col("code").alias("item"), "score")


def score_grid(users: DataFrame, items: Sequence[str], item: str = "item_id") -> DataFrame:
    """Every user with every item of an explicit list (one row explodes to one per item): the grid is
    as large as users times items, so score sparse pairs where the list is long."""
    return users.withColumn(item, F.explode(F.array(*[F.lit(i) for i in items])))


def recommend(scores: DataFrame, cutoff: int, seen: DataFrame | None = None, items: DataFrame | None = None,
              ignore: DataFrame | None = None, remove_top_pop: int = 0, interactions: DataFrame | None = None,
              users: DataFrame | None = None) -> DataFrame:
    """Ranked items ``(user, item, score, rank)`` up to the cutoff.

    ``items`` restricts the candidates; ``seen`` (user, item), ``ignore`` (item) and the
    ``remove_top_pop`` most popular items of ``interactions`` are never returned. Equal
    scores are ranked by item.
    """
    kept = scores
    if users is not None:
        kept = kept.join(users.select("user"), "user", "left_semi")
    if items is not None:
        kept = in_scope(kept, items, "item")
    if seen is not None:
        kept = kept.join(seen.select("user", "item"), ["user", "item"], "left_anti")
    if ignore is not None:
        kept = kept.join(ignore.select("item"), "item", "left_anti")
    if remove_top_pop:
        kept = kept.join(popular_items(interactions, remove_top_pop, "item").select("item"), "item", "left_anti")
    best = W.partitionBy("user").orderBy(F.desc("score"), F.asc("item"))
    return kept.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= cutoff)


def with_zero_tail(scores: DataFrame, users: DataFrame, items: Sequence[str]) -> DataFrame:
    """Score 0 for the listed items a user has no score for, so that lists can be filled up."""
    grid = score_grid(users.select("user").distinct(), items, "item")
    return (grid.join(scores, ["user", "item"], "full")
            .select("user", "item", F.coalesce("score", F.lit(0.0)).alias("score")))


def as_lists(ranked: DataFrame) -> DataFrame:
    """One array of items and one of scores per user, in rank order (at most the cutoff long)."""
    rows = ranked.groupBy("user").agg(F.array_sort(F.collect_list(F.struct("rank", "item", "score"))).alias("_r"))
    return rows.select("user", F.transform("_r", lambda r: r["item"]).alias("items"),
                       F.transform("_r", lambda r: r["score"]).alias("scores"))


def align(tables: Sequence[DataFrame], key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Prediction tables side by side on their key, columns renamed ``<name>__<i>``."""
    named = [t.select(*key, *[F.col(f"`{c}`").alias(f"{c}__{i}") for c in columns]) for i, t in enumerate(tables)]
    return reduce(lambda a, b: a.join(b, list(key)), named)


def blend(tables: Sequence[DataFrame], weights: Sequence[float], key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Weighted sum of prediction tables, matched by key (never by row position)."""
    def mixed(c: str) -> Column:
        return reduce(lambda a, b: a + b, [F.lit(float(w)) * F.col(f"`{c}__{i}`") for i, w in enumerate(weights)])

    return align(tables, key, columns).select(*key, *[mixed(c).alias(c) for c in columns])


def average_folds(predictions: DataFrame, folds: DataFrame, key: Sequence[str], columns: Sequence[str],
                  gate: float = 0.79) -> DataFrame:
    """Mean prediction over the folds whose validation accuracy exceeds the gate."""
    good = folds.filter(F.col("accuracy") > gate).select("fold")
    return (predictions.join(good, "fold", "left_semi").groupBy(*key)
            .agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in columns]))


def override_known(predictions: DataFrame, known: DataFrame, key: str, column: str) -> DataFrame:
    """Known values take the place of predictions where the key has one."""
    facts = known.select(key, F.col(column).alias("_known"))
    return (predictions.join(facts, key, "left")
            .withColumn(column, F.coalesce("_known", column)).select(*predictions.columns))
