"""Splits, folds, class balance and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.catalog.base import SEED, TARGETS, TX, ctes, draw_order_sql, draw_sql, labels_sql, register, table, transactions
from trolley.functions.draws import DRAW_RANGE, draw_order
from trolley.operators import metrics as M
from trolley.operators import models, sampling as S
from trolley.operators.ordering import number_rows
from trolley.operators.reshape import labels


@register("split", f"SELECT o_orderkey, CASE WHEN {draw_sql(SEED, 'o_orderkey')} < {int(0.1 * DRAW_RANGE)} THEN 1 ELSE 0 END AS held FROM orders")
def split(spark, d):
    train, held = S.split(table(spark, d, "orders").select("o_orderkey"), 0.1, SEED, ["o_orderkey"])
    return train.withColumn("held", F.lit(0)).unionByName(held.withColumn("held", F.lit(1)))


@register("chunk_users", f"SELECT c_custkey, {draw_sql(SEED, 'c_custkey')} % 100 AS chunk FROM customer")
def chunk_users(spark, d):
    return S.chunk_users(table(spark, d, "customer").select("c_custkey"), 100, SEED, "c_custkey")


@register("shuffle", f"SELECT c_custkey, row_number() OVER (ORDER BY {draw_order_sql(SEED, 'c_custkey')}) AS place FROM customer")
def shuffle(spark, d):
    """The drawn order itself does not show in an unordered comparison; its row numbers do."""
    customers = S.shuffle(table(spark, d, "customer").select("c_custkey"), SEED, ["c_custkey"])
    return number_rows(customers, [draw_order(SEED, F.col("c_custkey"))], "place")


@register("kfold", """SELECT doc_id, CASE WHEN i < big * (size + 1) THEN i // (size + 1) ELSE big + (i - big * (size + 1)) // size END AS fold
 FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () // 10 AS size, count(*) OVER () % 10 AS big FROM labels)""")
def kfold(spark, d):
    return S.kfold(table(spark, d, "labels").select("doc_id"), 10, [F.asc("doc_id")])


@register("head_split", "SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= 11000 THEN 0 ELSE 1 END AS part FROM orders")
def head_split(spark, d):
    head, tail = S.head_split(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), 11000, [F.asc("o_orderdate"), F.asc("o_orderkey")])
    return head.select("o_orderkey", F.lit(0).alias("part")).unionByName(tail.select("o_orderkey", F.lit(1).alias("part")))


@register("undersample", f"""SELECT doc_id, toxic FROM (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY {draw_order_sql(SEED, 'doc_id')}) AS rn,
 sum(toxic) OVER () AS ones, count(*) OVER () - sum(toxic) OVER () AS zeros FROM labels) WHERE rn <= least(ones, zeros)""")
def undersample(spark, d):
    return S.undersample(table(spark, d, "labels").select("doc_id", "toxic"), "toxic", SEED, ["doc_id"])


TARGET_COLUMNS = [f"Target_{t}" for t in TARGETS]


@register("class_weights", "SELECT target, greatest(1, ln(0.3 * sum(n) OVER () / CASE WHEN n = 0 THEN 1 ELSE n END)) AS weight FROM (UNPIVOT (SELECT "
          + ", ".join(f'sum("{c}") AS "{c}"' for c in TARGET_COLUMNS) + " FROM (" + ctes(TX) + labels_sql(
              "tx", ["customer_id"]) + ")) ON "
          + ", ".join(f'"{c}"' for c in TARGET_COLUMNS) + " INTO NAME target VALUE n)", ["weight"], 6)
def class_weights(spark, d):
    return S.class_weights(labels(transactions(spark, d), TARGETS), TARGET_COLUMNS, 0.3)


SCORED = """scored AS (SELECT doc_id, quality AS label, 1 / (1 + exp(2 - n_chars / 1000.0)) AS probability,
 CASE WHEN 1 / (1 + exp(2 - n_chars / 1000.0)) > 0.5 THEN 1 ELSE 0 END AS prediction FROM labels JOIN documents USING (doc_id))"""


def scored(spark, d):
    """Quality labels scored by a fixed function of the text length."""
    joined = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    p = 1.0 / (1.0 + F.exp(2.0 - F.col("n_chars") / 1000.0))
    return joined.select("doc_id", F.col("quality").alias("label"), p.alias("probability"), F.when(p > 0.5, 1).otherwise(0).alias("prediction"))


@register("auc", ctes(SCORED) + """SELECT sum(CASE WHEN p.probability > n.probability THEN 1.0 WHEN p.probability = n.probability THEN 0.5 ELSE 0.0 END)::DOUBLE / count(*) AS auc
 FROM scored p, scored n WHERE p.label = 1 AND n.label = 0""", ["auc"], 8)
def auc(spark, d):
    return M.auc(scored(spark, d), "probability")


@register("auc_orders", """SELECT (sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
 / (count(*) FILTER (WHERE y = 1) * 1.0 * count(*) FILTER (WHERE y = 0)) AS auc FROM (SELECT y, rank() OVER (ORDER BY q) + (count(*) OVER (PARTITION BY q) - 1) / 2.0 AS r
 FROM (SELECT l_quantity AS q, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem))""", ["auc"], 8)
def auc_orders(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_quantity").alias("score"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))
    return M.auc(lines)


CLIPPED = "greatest(least(probability, 1 - 1e-7), 1e-7)"


@register("metrics", ctes(SCORED) + f"""SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy,
 1 - sum((label - probability) * (label - probability)) / (var_pop(label) * count(*)) AS r2, avg((label - probability) * (label - probability)) AS mse,
 avg(-(label * ln({CLIPPED}) + (1 - label) * ln(1 - {CLIPPED}))) AS bce FROM scored""", ["accuracy", "r2", "mse", "bce"], 6)
def metrics(spark, d):
    return M.metrics(scored(spark, d))


@register("log_loss", ctes(SCORED) + f"SELECT avg(-ln(greatest(least(CASE WHEN label = 1 THEN probability ELSE 1 - probability END, 1 - 1e-7), 1e-7))) AS log_loss FROM scored", ["log_loss"], 6)
def log_loss(spark, d):
    two = scored(spark, d).withColumn("q", 1 - F.col("probability"))
    return two.agg(M.log_loss("label", ["q", "probability"]).alias("log_loss"))


@register("focal_loss", ctes(SCORED) + f"""SELECT sum(power(1 - pt, 2) * -ln(pt)) AS focal_loss FROM
 (SELECT CASE WHEN label = 1 THEN {CLIPPED} ELSE 1 - {CLIPPED} END AS pt FROM scored)""", ["focal_loss"], 6)
def focal_loss(spark, d):
    return M.focal_loss(scored(spark, d))


@register("minmax", """SELECT l_orderkey, l_linenumber, (l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()) AS l_quantity,
 (l_extendedprice - min(l_extendedprice) OVER ()) / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()) AS l_extendedprice FROM lineitem""", ["l_quantity", "l_extendedprice"], 6)
def minmax(spark, d):
    return models.minmax(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])


@register("standardise", """SELECT l_orderkey, l_linenumber, (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS l_quantity,
 (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS l_extendedprice FROM lineitem""", ["l_quantity", "l_extendedprice"], 6)
def standardise(spark, d):
    return models.standardise(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
