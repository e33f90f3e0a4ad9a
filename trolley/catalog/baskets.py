"""Frequent itemsets and rules over order baskets."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.catalog.base import TX, ctes, register, transactions
from trolley.operators import baskets as B
from trolley.session import materialise

MIN_SUPP, MIN_CONF, RHS = 0.015, 0.13, "Brand#5"

# Itemset levels in SQL: distinct items, then prefix joins of the frequent sets of the level below.
LEVELS = [TX, "items AS (SELECT DISTINCT transaction_id AS b, item_id AS i FROM tx)", "n AS (SELECT count(DISTINCT b) AS n FROM items)",
          f"s1 AS (SELECT i AS a, count(*) AS freq FROM items GROUP BY i HAVING count(*) / (SELECT n FROM n) >= {MIN_SUPP})",
          "f AS (SELECT b, i FROM items WHERE i IN (SELECT a FROM s1))",
          f"s2 AS (SELECT x.i AS a, y.i AS c, count(*) AS freq FROM f x JOIN f y ON x.b = y.b AND x.i < y.i GROUP BY ALL HAVING count(*) / (SELECT n FROM n) >= {MIN_SUPP})",
          f"s3 AS (SELECT x.i AS a, y.i AS c, z.i AS e, count(*) AS freq FROM f x JOIN f y ON x.b = y.b AND x.i < y.i JOIN f z ON x.b = z.b AND y.i < z.i GROUP BY ALL HAVING count(*) / (SELECT n FROM n) >= {MIN_SUPP})",
          "sets AS (SELECT a AS items, 1 AS k, freq FROM s1 UNION ALL SELECT a || '|' || c, 2, freq FROM s2 UNION ALL SELECT a || '|' || c || '|' || e, 3, freq FROM s3)"]
SETS = ctes(*LEVELS) + "SELECT * FROM sets"


def order_baskets(spark, d):
    """Stored, because most queries read them several times."""
    return materialise(B.to_baskets(transactions(spark, d, spread_out=True), "transaction_id", "item_id"), "baskets")


def named(found):
    return found.sets.select(F.array_join("items", "|").alias("items"), "k", "freq")


@register("to_baskets", ctes(TX) + "SELECT transaction_id, string_agg(item_id, '|' ORDER BY item_id) AS items FROM (SELECT DISTINCT transaction_id, item_id FROM tx) GROUP BY ALL")
def to_baskets(spark, d):
    return order_baskets(spark, d).select("transaction_id", F.array_join("items", "|").alias("items"))


@register("frequent_itemsets", SETS)
def frequent_itemsets(spark, d):
    return named(B.frequent_itemsets(order_baskets(spark, d), MIN_SUPP))


@register("frequent_itemsets_levelwise", SETS)
def frequent_itemsets_levelwise(spark, d):
    return named(B.frequent_itemsets_levelwise(order_baskets(spark, d), MIN_SUPP, "transaction_id"))


@register("join_itemsets", ctes(*LEVELS) + "SELECT x.a || '|' || y.a AS items FROM s1 x JOIN s1 y ON x.a < y.a UNION ALL SELECT x.a || '|' || x.c || '|' || y.c FROM s2 x JOIN s2 y ON x.a = y.a AND x.c < y.c")
def join_itemsets(spark, d):
    found = B.frequent_itemsets(order_baskets(spark, d), MIN_SUPP).sets
    pairs = B.join_itemsets(found.filter("k = 1")).unionByName(B.join_itemsets(found.filter("k = 2")))
    return pairs.select(F.array_join("items", "|").alias("items"))


@register("support_counts", ctes(*LEVELS) + """SELECT a.i || '|' || c.i AS items, count(*) AS freq FROM items a JOIN items c ON a.b = c.b AND a.i < c.i GROUP BY a.i || '|' || c.i""")
def support_counts(spark, d):
    """Exact counts of all pairs of brands, frequent or not."""
    baskets = order_baskets(spark, d)
    singles = baskets.select(F.explode("items").alias("i")).distinct().select(F.array("i").alias("items"))
    counts = B.support_counts(baskets, B.join_itemsets(singles), "transaction_id")
    return counts.select(F.array_join("items", "|").alias("items"), "freq")


@register("support", ctes(*LEVELS) + f"SELECT items, freq / (SELECT n FROM n) AS support FROM sets WHERE items = 'Brand#1|{RHS}'", ["support"], 8)
def support(spark, d):
    found = B.frequent_itemsets(order_baskets(spark, d), MIN_SUPP)
    return B.support(found, [RHS, "Brand#1"]).select(F.array_join("items", "|").alias("items"), "support")


@register("rules_for", ctes(*LEVELS) + f"""SELECT lhs, freq_both, l.freq AS freq_lhs, freq_both / l.freq AS confidence FROM
 (SELECT array_to_string(list_filter(string_split(items, '|'), lambda x: x <> '{RHS}'), '|') AS lhs, freq AS freq_both FROM sets
  WHERE k > 1 AND list_contains(string_split(items, '|'), '{RHS}')) JOIN sets l ON l.items = lhs WHERE freq_both / l.freq >= {MIN_CONF}""", ["confidence"], 8)
def rules_for(spark, d):
    rules = B.rules_for(B.frequent_itemsets(order_baskets(spark, d), MIN_SUPP), [RHS], MIN_CONF)
    return rules.select(F.array_join("lhs", "|").alias("lhs"), "freq_both", "freq_lhs", "confidence")


@register("rules_for_unknown", "SELECT NULL::VARCHAR AS lhs, NULL::DOUBLE AS confidence WHERE false")
def rules_for_unknown(spark, d):
    rules = B.rules_for(B.frequent_itemsets(order_baskets(spark, d), MIN_SUPP), ["Brand#none"], MIN_CONF)
    return rules.select(F.array_join("lhs", "|").alias("lhs"), "confidence")
