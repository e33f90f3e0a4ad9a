"""RFM, gaps, recency, ranks, dictionaries and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.catalog.base import (EV, TARGET_LIST, TARGETS, TX, ctes, days_sql, event_purchases, gap_names, gaps_sql, labels_sql,
                                  measures_sql, register, select_sql, stored_transactions, table, transactions)
from trolley.functions.dates import floor_days, micros, reference_date, time_literal
from trolley.operators import filters, gaps, ordering, rfm, summary
from trolley.operators.reshape import labels, widen

RD = 'r AS (SELECT max("InvoiceDate") AS rd FROM tx)'
OWN = 'own AS (SELECT tx.*, max("InvoiceDate") OVER (PARTITION BY customer_id) AS rd FROM tx)'
SUM_MIN_MAX = ("sum", "min", "max")


def _doubles(windows, **options):
    """All measures: counts too, since an empty window is NULL and compares as a number."""
    return list(measures_sql(windows, "rd", **options))


def _rfm_sql(keys, windows, source="tx, r", cte=RD, **options):
    return (ctes(TX, cte) + f"SELECT {keys}, {select_sql(measures_sql(windows, 'rd', **options))} FROM {source} "
            f'WHERE "InvoiceDate" >= rd - INTERVAL {max(windows)} DAY GROUP BY {keys}')


@register("pair_rfm", _rfm_sql("customer_id, item_id", rfm.WINDOWS), _doubles(rfm.WINDOWS))
def pair_rfm(spark, d):
    df = transactions(spark, d)
    return rfm.pair_rfm(df, ref=reference_date(df))


@register("rfm_with_recency", ctes(TX, RD) + f"""SELECT customer_id, item_id, {select_sql(measures_sql((30, 90, 360), 'rd'))},
 {days_sql('max(rd)', 'max("InvoiceDate")')} AS "R_L", {days_sql('max(rd)', 'min("InvoiceDate")')} AS "R_F"
 FROM tx, r GROUP BY customer_id, item_id""", _doubles((30, 90, 360)))
def rfm_with_recency(spark, d):
    df = stored_transactions(spark, d)
    return rfm.dated(df, reference_date(df)).groupBy(*rfm.PAIR).agg(*rfm.window_features((30, 90, 360)), *rfm.recency_features("R"))


@register("pair_rfm_stats", _rfm_sql("customer_id, item_id", rfm.WINDOWS_LONG, amount=SUM_MIN_MAX, quantity=SUM_MIN_MAX),
          _doubles(rfm.WINDOWS_LONG, amount=SUM_MIN_MAX, quantity=SUM_MIN_MAX))
def pair_rfm_stats(spark, d):
    df = transactions(spark, d)
    return rfm.pair_rfm(df, rfm.WINDOWS_LONG, reference_date(df), amount=SUM_MIN_MAX, quantity=SUM_MIN_MAX)


@register("customer_rfm", _rfm_sql("customer_id", rfm.WINDOWS_LONG, prefix="C", amount=SUM_MIN_MAX, quantity=SUM_MIN_MAX, sep="_"),
          _doubles(rfm.WINDOWS_LONG, prefix="C", amount=SUM_MIN_MAX, quantity=SUM_MIN_MAX, sep="_"))
def customer_rfm(spark, d):
    df = transactions(spark, d)
    return rfm.customer_rfm(df, ref=reference_date(df), amount=SUM_MIN_MAX, quantity=SUM_MIN_MAX, sep="_")


@register("pair_rfm_last_visit", _rfm_sql("customer_id, item_id", rfm.WINDOWS_LONG, "own", OWN, amount=("mean",)),
          _doubles(rfm.WINDOWS_LONG, amount=("mean",)))
def pair_rfm_last_visit(spark, d):
    return rfm.pair_rfm(stored_transactions(spark, d), rfm.WINDOWS_LONG, amount=("mean",))


@register("customer_rfm_last_visit", _rfm_sql("customer_id", rfm.WINDOWS_LONG, "own", OWN, prefix="C", amount=("mean",)),
          _doubles(rfm.WINDOWS_LONG, prefix="C", amount=("mean",)))
def customer_rfm_last_visit(spark, d):
    return rfm.customer_rfm(stored_transactions(spark, d), amount=("mean",))


@register("pair_rfm_net", _rfm_sql("customer_id, item_id", rfm.WINDOWS_LONG, "own", OWN, net=True),
          _doubles(rfm.WINDOWS_LONG, net=True))
def pair_rfm_net(spark, d):
    return rfm.pair_rfm(stored_transactions(spark, d), rfm.WINDOWS_LONG, net=True)


@register("customer_rfm_net", _rfm_sql("customer_id", rfm.WINDOWS_LONG, "own", OWN, prefix="C", amount=("mean",), net=True),
          _doubles(rfm.WINDOWS_LONG, prefix="C", amount=("mean",), net=True))
def customer_rfm_net(spark, d):
    return rfm.customer_rfm(stored_transactions(spark, d), amount=("mean",), net=True)


@register("rfm_join", _rfm_sql("customer_id, item_id", (30, 90, 360)), _doubles((30, 90, 360)))
def rfm_join(spark, d):
    df = stored_transactions(spark, d)
    ref = reference_date(df)
    return rfm.rfm_join([rfm.pair_rfm(df, (w,), ref) for w in (30, 90, 360)])


@register("with_net_price", ctes(TX) + "SELECT tx.*, item_amt * item_qty AS net_price FROM tx", ["net_price"], 2)
def with_net_price(spark, d):
    return rfm.with_net_price(transactions(spark, d))


@register("with_ref_dates", ctes(TX, RD) + "SELECT transaction_id, item_id, " + ", ".join(
    f'CAST(CAST(rd - INTERVAL {w} DAY AS DATE) AS VARCHAR) AS rd{w}' for w in rfm.WINDOWS) + " FROM tx, r")
def with_ref_dates(spark, d):
    df = transactions(spark, d)
    dated = rfm.with_ref_dates(df, ref=reference_date(df))
    return dated.select("transaction_id", "item_id", *[F.col(f"rd{w}").cast("date").cast("string").alias(f"rd{w}") for w in rfm.WINDOWS])


@register("with_ref_dates_customer", ctes(EV) + """SELECT transaction_id, epoch_us(rd) AS rd, """ + ", ".join(
    f"epoch_us(rd - INTERVAL {w} DAY) AS rd{w}" for w in rfm.WINDOWS) + """
FROM (SELECT ev.*, max("InvoiceDate") OVER (PARTITION BY customer_id) AS rd FROM ev)""")
def with_ref_dates_customer(spark, d):
    dated = rfm.with_ref_dates(event_purchases(spark, d))
    return dated.select("transaction_id", *[micros(F.col(c)).alias(c) for c in ["rd", *[f"rd{w}" for w in rfm.WINDOWS]]])


@register("recency", ctes(TX, RD) + f"""SELECT customer_id, item_id, {days_sql('max(rd)', 'max("InvoiceDate")')} AS "R_L",
 {days_sql('max(rd)', 'min("InvoiceDate")')} AS "R_F" FROM tx, r GROUP BY customer_id, item_id""")
def recency(spark, d):
    df = transactions(spark, d)
    return rfm.recency(df, reference_date(df))


@register("recency_customer", ctes(EV) + f"""SELECT customer_id, {days_sql('max(rd)', 'max("InvoiceDate")')} AS "T_L",
 {days_sql('max(rd)', 'min("InvoiceDate")')} AS "T_F" FROM ev, (SELECT max("InvoiceDate") AS rd FROM ev) GROUP BY customer_id""")
def recency_customer(spark, d):
    df = event_purchases(spark, d)
    return rfm.recency(df, reference_date(df), rfm.CUSTOMER, "T")


@register("span_days", ctes(EV) + f"""SELECT customer_id, item_id, {days_sql('max("InvoiceDate")', 'min("InvoiceDate")')} AS "R_F"
 FROM ev GROUP BY customer_id, item_id""")
def span_days(spark, d):
    return rfm.span_days(event_purchases(spark, d))


@register("span_days_customer", ctes(TX) + f"""SELECT customer_id, {days_sql('max("InvoiceDate")', 'min("InvoiceDate")')} AS "T_F"
 FROM tx GROUP BY customer_id""")
def span_days_customer(spark, d):
    return rfm.span_days(transactions(spark, d), rfm.CUSTOMER, "T_F")


@register("floor_days", ctes(EV) + f"""SELECT transaction_id, {days_sql('"InvoiceDate"', "TIMESTAMP '2024-01-15 12:00:00'")} AS days FROM ev""")
def floored_days(spark, d):
    return event_purchases(spark, d).select(
        "transaction_id", floor_days(F.col("InvoiceDate"), time_literal("2024-01-15 12:00:00")).alias("days"))


def _gap_entry(name, source, load, keys, prefix="", fill_before=False):
    cte, alias = source

    @register(name, ctes(cte) + gaps_sql(alias, keys, prefix, fill_before), gap_names(prefix))
    def build(spark, d):
        return gaps.gap_stats(load(spark, d), keys, fill_before=fill_before, prefix=prefix)
    return build


_gap_entry("gap_stats", (TX, "tx"), stored_transactions, rfm.PAIR)
_gap_entry("gap_stats_filled", (TX, "tx"), stored_transactions, rfm.PAIR, fill_before=True)
_gap_entry("gap_stats_customer", (TX, "tx"), stored_transactions, rfm.CUSTOMER, "C_")
_gap_entry("gap_stats_events", (EV, "ev"), event_purchases, rfm.PAIR)
_gap_entry("gap_stats_events_customer", (EV, "ev"), event_purchases, rfm.CUSTOMER, "C_")


def _lag_sql(source, keys):
    by = ", ".join(keys)
    cells = ", ".join(f'CAST(CAST(lag("InvoiceDate", {i}) OVER w AS DATE) AS VARCHAR) AS lag{i}, ' + days_sql('"InvoiceDate"', f'lag("InvoiceDate", {i}) OVER w')
                      + f" AS gap{i}" for i in (1, 2, 3))
    return f'SELECT {by}, CAST(CAST("InvoiceDate" AS DATE) AS VARCHAR) AS day, {cells} FROM {source} WINDOW w AS (PARTITION BY {by} ORDER BY "InvoiceDate")'


def _lagged(df, keys):
    return gaps.lags(df, keys).select(*keys, F.col("InvoiceDate").cast("date").cast("string").alias("day"), *[
        c for i in (1, 2, 3) for c in (F.col(f"lag{i}").cast("date").cast("string").alias(f"lag{i}"), F.col(f"gap{i}"))])


@register("lags", ctes(TX) + _lag_sql("tx", rfm.PAIR), ["gap1", "gap2", "gap3"])
def lags(spark, d):
    return _lagged(stored_transactions(spark, d), rfm.PAIR)


@register("lags_customer", ctes(EV) + _lag_sql("ev", rfm.CUSTOMER), ["gap1", "gap2", "gap3"])
def lags_customer(spark, d):
    return _lagged(event_purchases(spark, d), rfm.CUSTOMER)


@register("visit_rank", ctes(TX) + """SELECT customer_id, transaction_id, item_id, item_amt,
 dense_rank() OVER (PARTITION BY customer_id ORDER BY "InvoiceDate" DESC) AS rank FROM tx""")
def visit_rank(spark, d):
    return summary.visit_rank(stored_transactions(spark, d)).select("customer_id", "transaction_id", "item_id", "item_amt", "rank")


@register("label_rows", ctes(TX) + f"""SELECT customer_id, item_id, transaction_id, item_qty FROM (SELECT tx.*,
 dense_rank() OVER (PARTITION BY customer_id ORDER BY "InvoiceDate" DESC) AS rank FROM tx)
 WHERE item_id IN ({TARGET_LIST}) AND rank <= 1 AND item_qty > 0""")
def label_rows(spark, d):
    ranked = summary.visit_rank(stored_transactions(spark, d))
    return filters.label_rows(ranked, TARGETS).select("customer_id", "item_id", "transaction_id", "item_qty")


@register("labels", ctes(TX) + labels_sql("""(SELECT * FROM tx WHERE "InvoiceDate" > (SELECT max("InvoiceDate") - INTERVAL 60 DAY FROM tx))""",
                                          ["customer_id"]))
def labels_wide(spark, d):
    df = stored_transactions(spark, d)
    return labels(df.filter(F.col("InvoiceDate") > time_literal(reference_date(df, days=60))), TARGETS)


@register("widen", ctes(TX) + "SELECT customer_id, " + ", ".join(
    f"""{e} FILTER (WHERE item_id = '{t}') AS "{m}_{t}" """ for m, e in (("F", "nullif(count(*), 0)"), ("M", "sum(item_amt)")) for t in TARGETS)
    .replace("nullif(count(*), 0) FILTER", "count(*) FILTER") + " FROM tx GROUP BY customer_id", [f"M_{t}" for t in TARGETS], 2)
def widened(spark, d):
    pairs = transactions(spark, d).groupBy(*rfm.PAIR).agg(F.count(F.lit(1)).alias("F"), F.sum("item_amt").alias("M"))
    return widen(pairs, TARGETS, ["F", "M"]).na.fill(0, [f"F_{t}" for t in TARGETS])


@register("popular_items", ctes(TX) + "SELECT item_id, count(*) AS count FROM tx GROUP BY item_id ORDER BY count DESC, item_id LIMIT 10")
def popular_items(spark, d):
    return summary.popular_items(transactions(spark, d), 10)


@register("popularity_index", "SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, l_partkey) AS index FROM lineitem GROUP BY l_partkey")
def popularity_index(spark, d):
    return summary.popularity_index(table(spark, d, "lineitem"), "l_partkey")


@register("encode_ids", "SELECT p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS id FROM (SELECT DISTINCT p_name FROM part)")
def encode_ids(spark, d):
    return summary.encode_ids(table(spark, d, "part"), "p_name")


@register("encode_ids_customers", "SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS id FROM (SELECT DISTINCT c_name FROM customer)")
def encode_ids_customers(spark, d):
    return summary.encode_ids(table(spark, d, "customer"), "c_name")


@register("number_rows", "SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS row_no FROM events")
def number_rows(spark, d):
    return ordering.number_rows(table(spark, d, "events").select("event_id", "value"), [F.asc("value"), F.asc("event_id")]).select("event_id", "row_no")


@register("group_mode", """SELECT l_suppkey, item AS mode FROM (SELECT l_suppkey, l_quantity AS item,
 row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_quantity) AS rn FROM lineitem GROUP BY l_suppkey, l_quantity) WHERE rn = 1""")
def group_mode(spark, d):
    return summary.group_mode(table(spark, d, "lineitem"), "l_suppkey", "l_quantity")


@register("top_item", ctes(TX) + """SELECT customer_id, item_id AS "IMPP", n AS "IMPP_count" FROM (SELECT customer_id, item_id, count(*) AS n,
 row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, item_id) AS rn FROM tx GROUP BY customer_id, item_id) WHERE rn = 1""")
def top_item(spark, d):
    return summary.top_item(transactions(spark, d))


@register("implicit_rating", ctes(TX) + "SELECT customer_id, item_id, ln(1 + count(transaction_id)) AS rating FROM tx GROUP BY ALL", ["rating"], 6)
def implicit_rating(spark, d):
    return summary.implicit_rating(transactions(spark, d))


@register("n_unique", ctes(TX) + "SELECT count(DISTINCT customer_id) AS customer_id, count(DISTINCT item_id) AS item_id FROM tx")
def n_unique(spark, d):
    return summary.n_unique(transactions(spark, d), ["customer_id", "item_id"])


def _profile_sql(tablename, columns):
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
 CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
 quantile_cont({c}, 0.75) AS p75 FROM {tablename}""" for c in columns)


@register("profile", _profile_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]),
          ["mean", "std", "min", "max", "p25", "p50", "p75"])
def profile(spark, d):
    return summary.profile(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@register("null_counts", """SELECT count(*) FILTER (WHERE event_type IS NULL) AS event_type, count(*) FILTER (WHERE value IS NULL) AS value
 FROM (SELECT nullif(event_type, 'error') AS event_type, CASE WHEN value >= 10 THEN value END AS value FROM events)""")
def null_counts(spark, d):
    return summary.null_counts(table(spark, d, "events").select(
        F.nullif("event_type", F.lit("error")).alias("event_type"), F.when(F.col("value") >= 10, F.col("value")).alias("value")))


@register("bounds", "SELECT min(l_extendedprice) AS min, max(l_extendedprice) AS max FROM lineitem")
def bounds(spark, d):
    return summary.bounds(table(spark, d, "lineitem"), "l_extendedprice")


@register("base_rates", "SELECT " + ", ".join(f'avg("Target_{t}") AS "Target_{t}"' for t in TARGETS) + " FROM (" + ctes(TX) + labels_sql("tx", ["customer_id"]) + ")",
          [f"Target_{t}" for t in TARGETS], 6)
def base_rates(spark, d):
    return summary.base_rates(labels(transactions(spark, d), TARGETS), [f"Target_{t}" for t in TARGETS])


@register("class_counts", "SELECT quality, count(*) AS count FROM labels GROUP BY quality")
def class_counts(spark, d):
    return summary.class_counts(table(spark, d, "labels"), "quality")


@register("group_size", "SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS count FROM events")
def group_size(spark, d):
    return filters.group_size(table(spark, d, "events").select("event_id", "user_id"), ["user_id"])


@register("top_n", """SELECT customer_id, item_id, amount, rank FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY amount DESC, item_id) AS rn,
 dense_rank() OVER (PARTITION BY customer_id ORDER BY amount DESC) AS rank FROM (""" + ctes(TX) + """
 SELECT customer_id, item_id, count(*) AS amount FROM tx GROUP BY customer_id, item_id)) WHERE rn <= 10""")
def top_n(spark, d):
    counts = transactions(spark, d).groupBy(*rfm.PAIR).agg(F.count(F.lit(1)).alias("amount"))
    return summary.top_n(counts, rfm.CUSTOMER, "amount", 10, ["item_id"], "rank")


@register("rank_scores", "SELECT event_id, user_id, value, dense_rank() OVER (PARTITION BY user_id ORDER BY value DESC) AS rank FROM events")
def rank_scores(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "value")
    return ordering.dense_rank_in_key(events, ["user_id"], "value").select("event_id", "user_id", "value", "rank")


@register("first_per_key", """SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM (SELECT *, row_number() OVER
 (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def first_per_key(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    return summary.first_per_key(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


@register("dedup_features", """SELECT min(p_partkey) AS p_partkey, p_name, p_brand, p_type FROM part GROUP BY p_name, p_brand, p_type""")
def dedup_features(spark, d):
    return summary.dedup_features(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type"), ["p_partkey"])
