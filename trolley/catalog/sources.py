"""Readers, writers and stored tables, on files written from the given tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trolley.catalog.base import SEED, TX, ctes, draw_sql, register, table, transactions
from trolley.functions.dates import micros, parse_ts
from trolley.operators import summary
from trolley.operators.sampling import chunk_users
from trolley.session import scratch_path
from trolley.sources import tables as S


@register("read_transactions", """SELECT user_id AS customer_id, event_type AS item_id, event_id AS transaction_id, epoch_us(ts) AS micros,
 value AS item_qty, value AS item_amt FROM events""")
def read_transactions(spark, d):
    path = scratch_path(spark, "events-csv")
    events = table(spark, d, "events")
    S.write_csv(events.select("user_id", "event_type", "event_id", "ts", "value", F.col("value").alias("again")), path)
    back = S.read_transactions(spark, path)
    return back.select("customer_id", "item_id", "transaction_id", micros(F.col("InvoiceDate")).alias("micros"), "item_qty", "item_amt")


@register("read_table", "SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL ELSE p_size END AS p_size, p_name FROM part", ["p_size"])
def read_table(spark, d):
    path = scratch_path(spark, "part-csv")
    size = F.when(F.col("p_size") < 10, F.lit("-")).otherwise(F.col("p_size").cast("string"))
    S.write_csv(table(spark, d, "part").select("p_partkey", size.alias("p_size"), "p_name"), path)
    return S.read_table(spark, path, "p_partkey long, p_size int, p_name string", null_token="-")


@register("read_baskets", """SELECT array_to_string(list_sort(list_distinct(list_append(list(p_type), ''))), '|') AS items
 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""")
def read_baskets(spark, d):
    path = scratch_path(spark, "baskets")
    lines, part = table(spark, d, "lineitem"), table(spark, d, "part")
    rows = lines.join(part, lines["l_partkey"] == part["p_partkey"]).groupBy("l_orderkey").agg(F.collect_list("p_type").alias("t"))
    rows.select(F.concat(F.array_join("t", ","), F.lit(",\r")).alias("value")).write.text(path)
    return S.read_baskets(spark, path).select(F.array_join(F.array_sort("items"), "|").alias("items"))


@register("parse_ts", """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""")
def parsed_ts(spark, d):
    text = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", "dd.MM.yyyy"))
    return table(spark, d, "orders").select("o_orderkey", parse_ts(text, "dd.MM.yyyy", strict=False).cast("date").cast("string").alias("day"))


@register("write_csv", ctes(TX) + f"""SELECT customer_id, item_id, transaction_id, item_amt,
 CAST({draw_sql(SEED, 'customer_id')} % 4 AS INTEGER) AS chunk FROM tx""")
def write_csv(spark, d):
    path = scratch_path(spark, "chunks")
    rows = transactions(spark, d).select("customer_id", "item_id", "transaction_id", "item_amt")
    S.write_csv(chunk_users(rows, 4, SEED), path, ["chunk"])
    schema = "customer_id long, item_id string, transaction_id long, item_amt double, chunk int"
    return S.read_table(spark, path, schema)


@register("save_dict", "SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS id FROM (SELECT DISTINCT p_brand FROM part)")
def save_dict(spark, d):
    path = scratch_path(spark, "dictionary")
    S.save_dict(summary.encode_ids(table(spark, d, "part"), "p_brand"), path)
    return S.load_dict(spark, path)


@register("save_model", """SELECT p_partkey, (p_retailprice - (SELECT min(p_retailprice) FROM part)) /
 ((SELECT max(p_retailprice) FROM part) - (SELECT min(p_retailprice) FROM part)) AS scaled FROM part""", ["scaled"], 6)
def save_model(spark, d):
    path = scratch_path(spark, "model")
    part = table(spark, d, "part").select("p_partkey", "p_retailprice")
    stages = [VectorAssembler(inputCols=["p_retailprice"], outputCol="v"), MinMaxScaler(inputCol="v", outputCol="s")]
    S.save_model(path, weights=part, fitted=Pipeline(stages=stages).fit(part))
    scored = S.load_model(spark, path, "fitted").transform(S.load_model(spark, path))
    return scored.select("p_partkey", vector_to_array("s")[0].alias("scaled"))
