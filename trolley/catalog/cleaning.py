"""Cleaning, filters, joins and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.catalog.base import (SEED, TARGET_LIST, TARGETS, TX, ctes, draw_order_sql, labels_sql, register,
                                  stored_transactions, table, transactions)
from trolley.functions import columns as C
from trolley.functions import text as X
from trolley.functions.dates import micros, reference_date, time_literal
from trolley.operators import cleaning as K
from trolley.operators import filters, reshape, rfm
from trolley.operators.recommend import score_grid

HOLED = "holed AS (SELECT customer_id, transaction_id, nullif(item_id, 'Brand#3') AS item_id, CASE WHEN item_qty >= 5 THEN item_qty END AS item_qty FROM tx)"


def holed(spark, d):
    """Transactions with missing items and quantities (the given tables have no NULLs)."""
    return transactions(spark, d).select(
        "customer_id", "transaction_id", F.nullif("item_id", F.lit("Brand#3")).alias("item_id"),
        F.when(F.col("item_qty") >= 5, F.col("item_qty")).alias("item_qty"))


@register("drop_any_null", ctes(TX, HOLED) + "SELECT * FROM holed WHERE item_id IS NOT NULL AND item_qty IS NOT NULL")
def drop_any_null(spark, d):
    return K.drop_any_null(holed(spark, d))


@register("fill_penalty", ctes(TX, HOLED) + "SELECT customer_id, transaction_id, coalesce(item_id, '') AS item_id, coalesce(item_qty, 999) AS item_qty FROM holed")
def fill_penalty(spark, d):
    return K.fill_penalty(K.fill_penalty(holed(spark, d), 999), "")


@register("fill_by_pattern", ctes(TX, HOLED) + "SELECT customer_id, transaction_id, coalesce(item_id, '') AS item_id_sequence, coalesce(item_qty, -1) AS item_qty FROM holed")
def fill_by_pattern(spark, d):
    return K.fill_by_pattern(holed(spark, d).withColumnRenamed("item_id", "item_id_sequence").select(
        "customer_id", "transaction_id", "item_id_sequence", "item_qty"), {"_sequence": ""})


@register("extract_digits", "SELECT c_custkey, nullif(regexp_extract(c_name, '([0-9]+)', 1), '') AS digits, "
          "CAST(CAST(nullif(regexp_extract(c_name, '([0-9]+)', 1), '') AS BIGINT) AS VARCHAR) AS number, "
          "nullif(regexp_extract(c_mktsegment, '([0-9]+)', 1), '') AS none FROM customer")
def extract_digits(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", X.extract_digits(F.col("c_name")).alias("digits"), X.extract_digits(F.col("c_name"), True).alias("number"),
        X.extract_digits(F.col("c_mktsegment")).alias("none"))


@register("strip_symbols", r"""SELECT doc_id, md5(regexp_replace(text, '[^\p{L}\p{N}_\s.]', '', 'g')) AS kept,
 md5(regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g')) AS bare FROM documents""")
def strip_symbols(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.md5(X.strip_symbols(F.col("text"))).alias("kept"), F.md5(X.strip_symbols(F.col("text"), False)).alias("bare"))


FLAGS = {"F": "finished", "O": "open", "P": "pending"}


@register("sentinel_flags", "SELECT o_orderkey, " + ", ".join(f"CASE WHEN o_orderstatus = '{k}' THEN 1 ELSE 0 END AS {v}" for k, v in FLAGS.items()) + " FROM orders")
def sentinel_flags(spark, d):
    return K.sentinel_flags(table(spark, d, "orders"), "o_orderstatus", FLAGS).select("o_orderkey", *FLAGS.values())


@register("null_sentinels", "SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('P', 'F') THEN o_orderstatus END AS o_orderstatus FROM orders")
def null_sentinels(spark, d):
    return K.null_sentinels(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["P", "F"])


@register("null_sentinels_pad", """SELECT o_orderkey, last_value(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '5-LOW') THEN o_orderpriority END IGNORE NULLS)
 OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS o_orderpriority FROM orders""")
def null_sentinels_pad(spark, d):
    return K.null_sentinels(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority",
                            ["1-URGENT", "5-LOW"], [F.asc("o_orderkey")])


@register("impute_mode", """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN (SELECT o_orderpriority FROM orders GROUP BY o_orderpriority
 ORDER BY count(*) DESC, o_orderpriority LIMIT 1) ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def impute_mode(spark, d):
    return K.impute_mode(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "5-LOW")


@register("to_numeric", """SELECT p_partkey, TRY_CAST(CASE WHEN p_size % 5 = 0 THEN p_name ELSE CAST(p_retailprice AS VARCHAR) END AS DOUBLE) AS lenient,
 CAST(CAST(p_size AS VARCHAR) AS DOUBLE) AS strict FROM part""", ["lenient", "strict"])
def to_numeric(spark, d):
    mixed = F.when(F.col("p_size") % 5 == 0, F.col("p_name")).otherwise(F.col("p_retailprice").cast("string"))
    return table(spark, d, "part").select("p_partkey", C.to_number(mixed, False).alias("lenient"),
                                          C.to_number(F.col("p_size").cast("string")).alias("strict"))


FIXES = {"gurgoan": "gurgaon", "the ": "thee "}


@register("normalise_text", "SELECT doc_id, length(t) AS chars, md5(t) AS digest FROM (SELECT doc_id, replace(replace(replace("
          "regexp_replace(lower(text), '[,\\-.]', ' ', 'g'), 'gurgoan', 'gurgaon'), 'the ', 'thee '), '  ', ' ') AS t FROM documents)")
def normalise_text(spark, d):
    t = X.normalise_text(F.col("text"), FIXES, lower=True)
    return table(spark, d, "documents").select("doc_id", F.length(t).cast("long").alias("chars"), F.md5(t).alias("digest"))


@register("token_count", r"SELECT doc_id, len(regexp_extract_all(text, '\S+')) AS tokens FROM documents")
def token_count(spark, d):
    return table(spark, d, "documents").select("doc_id", X.token_count(F.col("text")).cast("long").alias("tokens"))


@register("recode", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '1' ELSE o_orderstatus END AS coded, "
          "o_orderstatus AS back FROM orders")
def recode(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("coded"))
    coded = K.recode(orders, "coded", {"F": "0", "O": "1"})
    return K.recode(coded.withColumn("back", F.col("coded")), "back", {"F": "0", "O": "1"}, reverse=True)


@register("recode_table", "SELECT l_orderkey, l_linenumber, l_quantity, p_name AS part FROM lineitem JOIN part ON l_partkey = p_partkey")
def recode_table(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_partkey").cast("string").alias("part"))
    return K.recode(lines, "part", table(spark, d, "part").select("p_partkey", "p_name"))


@register("tag", "SELECT p_partkey, 'ITEM_' || p_brand AS item FROM part")
def tagged(spark, d):
    return table(spark, d, "part").select("p_partkey", X.tag("ITEM_", F.col("p_brand")).alias("item"))


@register("log_shift", "SELECT l_orderkey, l_linenumber, l_quantity, ln(l_quantity + 1) AS log1, CASE WHEN l_quantity - 10 + 0.1 > 0 THEN ln(l_quantity - 10 + 0.1) END AS log01 FROM lineitem",
          ["log1", "log01"], 6)
def log_shift(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", C.log_shift(F.col("l_quantity"), 1.0).alias("log1"),
                                              C.log_shift(F.col("l_quantity") - 10, 0.1).alias("log01"))


YEARS = list(range(1995, 2002))


@register("row_sum", ctes(TX) + "SELECT customer_id, item_id, sum(item_qty) AS total FROM tx GROUP BY ALL", ["total"], 2)
def row_sum(spark, d):
    years = transactions(spark, d).groupBy("customer_id", "item_id").agg(
        *[F.sum(F.when(F.year("InvoiceDate") == y, F.col("item_qty"))).alias(f"y{y}") for y in YEARS])
    return years.select("customer_id", "item_id", C.row_sum(years.columns[2:]).alias("total"))


STATUSES = ["F", "O", "P"]


@register("one_hot", "SELECT o_orderkey, " + ", ".join(f"CASE WHEN o_orderstatus = '{s}' THEN 1 ELSE 0 END AS status_{s}" for s in STATUSES) + " FROM orders")
def one_hot(spark, d):
    return K.one_hot(table(spark, d, "orders"), "o_orderstatus", STATUSES, "status_").select("o_orderkey", *[f"status_{s}" for s in STATUSES])


@register("explode_list", "SELECT l_orderkey, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey")
def explode_list(spark, d):
    lists = transactions(spark, d).groupBy(F.col("transaction_id").alias("l_orderkey")).agg(F.array_join(F.collect_list("item_id"), ", ").alias("item"))
    return K.explode_list(lists, "item")


@register("shuffle_tokens", "SELECT p_partkey, string_agg(t, ' ' ORDER BY " + draw_order_sql(SEED, "p_partkey", "i - 1", "t") + """) AS words FROM
 (SELECT p_partkey, unnest(l) AS t, generate_subscripts(l, 1) AS i FROM (SELECT p_partkey, string_split(p_name || ' ' || p_brand || ' ' || p_type, ' ') AS l FROM part)) GROUP BY p_partkey""")
def shuffle_tokens(spark, d):
    words = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("words"))
    return K.shuffle_tokens(words, "words", "p_partkey", SEED, " ")


@register("cast_key", "SELECT c_custkey, CAST(CAST(c_custkey AS VARCHAR) || '.0' AS DOUBLE)::BIGINT AS key FROM customer")
def cast_key(spark, d):
    return table(spark, d, "customer").select("c_custkey", C.cast_key(F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))).alias("key"))


@register("time_split", """SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-20 12:00:00' THEN 1 ELSE 0 END AS holdout FROM events""")
def time_split(spark, d):
    before, after = filters.time_split(table(spark, d, "events"), "2024-01-20 12:00:00", "ts")
    return before.select("event_id", F.lit(0).alias("holdout")).unionByName(after.select("event_id", F.lit(1).alias("holdout")))


@register("as_of", "SELECT event_id, user_id, epoch_us(ts) AS micros FROM events WHERE ts <= (SELECT max(ts) - INTERVAL 7 DAY FROM events)")
def as_of(spark, d):
    return filters.as_of(table(spark, d, "events"), 7, "ts").select("event_id", "user_id", micros(F.col("ts")).alias("micros"))


@register("only_items", ctes(TX) + f"SELECT customer_id, item_id, transaction_id, item_amt FROM tx WHERE item_id IN ({TARGET_LIST})")
def only_items(spark, d):
    return filters.only_items(transactions(spark, d), TARGETS).select("customer_id", "item_id", "transaction_id", "item_amt")


@register("not_in", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def not_in(spark, d):
    big = table(spark, d, "orders").filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return filters.not_in(table(spark, d, "customer").select("c_custkey", "c_name"), big, ["c_custkey"])


@register("valid_keys", "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey <> 0")
def valid_keys(spark, d):
    return filters.valid_keys(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_custkey")


@register("min_activity", ctes(TX) + "SELECT customer_id, item_id, transaction_id, item_amt FROM tx QUALIFY count(*) OVER (PARTITION BY customer_id) > 45")
def min_activity(spark, d):
    return filters.min_activity(transactions(spark, d).select("customer_id", "item_id", "transaction_id", "item_amt"), 45)


@register("clean_scores", "SELECT l_partkey, l_suppkey, l_discount FROM lineitem WHERE l_discount <> 0 AND l_suppkey <> 1")
def clean_scores(spark, d):
    return filters.clean_scores(table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_discount"), 1, "l_suppkey", "l_discount")


@register("error_rows", "SELECT doc_id, quality, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS guess FROM labels JOIN documents USING (doc_id) WHERE quality <> CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END")
def error_rows(spark, d):
    guesses = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", "quality", F.when(F.col("n_chars") > 1000, 1).otherwise(0).alias("guess"))
    return filters.error_rows(guesses, "quality", "guess")


@register("in_scope", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')")
def in_scope(spark, d):
    items = table(spark, d, "part").filter(F.col("p_type") == "ECONOMY").select(F.col("p_partkey").alias("l_partkey"))
    return filters.in_scope(table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"), items, "l_partkey")


RECENT = """SELECT DISTINCT o_custkey AS customer_id FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) - INTERVAL 90 DAY FROM orders)"""


def recent_customers(spark, d):
    orders = table(spark, d, "orders")
    return orders.filter(F.col("o_orderdate") > time_literal(reference_date(orders, "o_orderdate", 90))).select(
        F.col("o_custkey").alias("customer_id")).distinct()


@register("restrict_to", f"SELECT c_custkey AS customer_id, c_acctbal FROM customer WHERE c_custkey IN ({RECENT})")
def restrict_to(spark, d):
    return filters.restrict_to(table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), "c_acctbal"), recent_customers(spark, d))


@register("missing_from", f"SELECT c_custkey AS customer_id, c_acctbal FROM customer WHERE c_custkey NOT IN ({RECENT})")
def missing_from(spark, d):
    return filters.missing_from(table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), "c_acctbal"), recent_customers(spark, d))


CUST = "SELECT c_custkey AS customer_id, c_acctbal FROM customer"
SPEND = "SELECT o_custkey AS customer_id, sum(o_totalprice) AS spend FROM orders GROUP BY o_custkey"
LATE = "SELECT o_custkey AS customer_id, count(*) AS late FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey"
EARLY = "SELECT o_custkey AS customer_id, count(*) AS early FROM orders WHERE o_orderdate < TIMESTAMP '1995-07-01' GROUP BY o_custkey"


def customer_blocks(spark, d):
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "customer_id")
    return (table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), "c_acctbal"),
            orders.groupBy("customer_id").agg(F.sum("o_totalprice").alias("spend")),
            orders.filter(F.col("o_orderdate") >= time_literal("2001-01-01 00:00:00")).groupBy("customer_id").agg(F.count(F.lit(1)).alias("late")),
            orders.filter(F.col("o_orderdate") < time_literal("1995-07-01 00:00:00")).groupBy("customer_id").agg(F.count(F.lit(1)).alias("early")))


@register("assemble_customer", f"SELECT * FROM ({CUST}) LEFT JOIN ({SPEND}) USING (customer_id) LEFT JOIN ({LATE}) USING (customer_id)", ["spend", "late"], 2)
def assemble_customer(spark, d):
    base, spend, late, _ = customer_blocks(spark, d)
    return reshape.assemble_customer(base, [spend, late])


@register("outer_blocks", f"SELECT * FROM ({LATE}) FULL JOIN ({EARLY}) USING (customer_id)", ["late", "early"], 2)
def outer_blocks(spark, d):
    _, _, late, early = customer_blocks(spark, d)
    return reshape.outer_blocks([late, early])


@register("attach_labels", f"SELECT * FROM ({SPEND}) JOIN ({LATE}) USING (customer_id)", ["spend"], 2)
def attach_labels(spark, d):
    _, spend, late, _ = customer_blocks(spark, d)
    return reshape.attach_labels(spend, late)


PAST = "past AS (SELECT * FROM tx WHERE \"InvoiceDate\" <= TIMESTAMP '2001-05-01')"
NEW = "fresh AS (SELECT * FROM tx WHERE \"InvoiceDate\" > TIMESTAMP '2001-05-01')"


@register("attach_long_labels", ctes(TX, PAST, NEW) + f"""SELECT customer_id, item_id, coalesce(n, 999) AS n, coalesce(amount, 999) AS amount, "Target" FROM
 (SELECT c.customer_id, i.item_id, CASE WHEN y.item_id IS NULL THEN 0 ELSE 1 END AS "Target" FROM (SELECT DISTINCT customer_id FROM fresh WHERE item_id IN ({TARGET_LIST})) c
  CROSS JOIN (SELECT unnest([{TARGET_LIST}]) AS item_id) i LEFT JOIN (SELECT DISTINCT customer_id, item_id FROM fresh) y ON y.customer_id = c.customer_id AND y.item_id = i.item_id)
 LEFT JOIN (SELECT customer_id, item_id, count(*) AS n, sum(item_amt) AS amount FROM past GROUP BY ALL) USING (customer_id, item_id)""", ["amount"], 2)
def attach_long_labels(spark, d):
    past, fresh = filters.time_split(stored_transactions(spark, d), "2001-05-02 00:00:00")
    features = past.groupBy(*rfm.PAIR).agg(F.count(F.lit(1)).alias("n"), F.sum("item_amt").alias("amount"))
    return reshape.attach_long_labels(features, reshape.labels_long(fresh, TARGETS))


@register("score_grid", f"SELECT c_custkey AS customer_id, item_id FROM customer CROSS JOIN (SELECT unnest([{TARGET_LIST}]) AS item_id)")
def grid(spark, d):
    return score_grid(table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id")), TARGETS)


@register("melt_labels", ctes(TX) + "UNPIVOT (SELECT customer_id, " + ", ".join(f'"Target_{t}" AS "{t}"' for t in TARGETS) + f" FROM ({labels_sql('tx', ['customer_id'])})) ON "
          + ", ".join(f'"{t}"' for t in TARGETS) + ' INTO NAME item_id VALUE "Target"')
def melt_labels(spark, d):
    return reshape.melt_labels(reshape.labels(transactions(spark, d), TARGETS), TARGETS)


@register("unpivot_scores", "UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME item_id VALUE score")
def unpivot_scores(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return reshape.unpivot_scores(lines, ["l_quantity", "l_discount", "l_tax"], ["l_orderkey", "l_linenumber"])


@register("to_template", ctes(TX) + "SELECT customer_id, " + ", ".join(f"""max(item_qty) FILTER (WHERE item_id = '{t}') AS "Target_{t}" """ for t in TARGETS) + " FROM tx GROUP BY customer_id",
          [f"Target_{t}" for t in TARGETS])
def to_template(spark, d):
    preds = transactions(spark, d).select(F.col("customer_id").cast("string").alias("customer_id"), "item_id", F.col("item_qty").alias("Target"))
    return reshape.to_template(preds, TARGETS)


@register("stack_universes", ctes(TX) + """SELECT customer_id, item_id, item_qty FROM tx WHERE "InvoiceDate" < TIMESTAMP '1998-01-01'
 UNION ALL SELECT customer_id, item_id, item_qty FROM tx WHERE "InvoiceDate" >= TIMESTAMP '1998-01-01'""")
def stack_universes(spark, d):
    first, second = filters.time_split(transactions(spark, d), "1998-01-01 00:00:00")
    return reshape.stack_universes([first.select("customer_id", "item_id", "item_amt", "item_qty"),
                                    second.select("item_qty", "transaction_id", "item_id", "customer_id")])


@register("append", "SELECT doc_id, quality, NULL::BIGINT AS n_chars FROM labels UNION ALL SELECT doc_id, NULL::INTEGER, n_chars FROM documents", ["quality", "n_chars"])
def append(spark, d):
    return reshape.append(table(spark, d, "labels").select("doc_id", "quality"), table(spark, d, "documents").select("doc_id", "n_chars"))


@register("order_by_customer", f"{CUST} ORDER BY customer_id")
def order_by_customer(spark, d):
    return customer_blocks(spark, d)[0].orderBy("customer_id")


@register("argmax", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount >= l_tax AND l_discount >= 0.05 THEN 'l_discount' WHEN l_tax >= 0.05 THEN 'l_tax' ELSE 'floor' END AS best FROM lineitem")
def argmax(spark, d):
    lines = table(spark, d, "lineitem").withColumn("floor", F.lit(0.05))
    return lines.select("l_orderkey", "l_linenumber", C.argmax(["l_discount", "l_tax", "floor"]).alias("best"))
