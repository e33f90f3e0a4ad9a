"""Item-item models, scores, ranked lists and blends."""

from __future__ import annotations

from pyspark.sql import functions as F

from trolley.catalog.base import TARGET_LIST, TARGETS, TX, ctes, labels_sql, register, stored_transactions, table, transactions
from trolley.operators import elastic, recommend as R
from trolley.operators.reshape import labels
from trolley.operators.summary import group_mode
from trolley.plans import scoring
from trolley.session import materialise

PROFILE = 'profile AS (SELECT customer_id AS "user", item_id AS item, sum(ln(item_qty + 0.1)) AS value FROM tx GROUP BY ALL)'
ORDERS = "inorder AS (SELECT DISTINCT transaction_id AS t, item_id AS item FROM tx)"
WEIGHTS = ("weights AS (SELECT x.item AS item_from, y.item AS item_to, count(*) / 1000.0 AS weight FROM inorder x JOIN inorder y USING (t) "
           "WHERE x.item <> y.item GROUP BY ALL)")
SCORES = 'scores AS (SELECT "user", item_to AS item, sum(value * weight) AS score FROM profile JOIN weights ON item = item_from GROUP BY "user", item_to)'
SUPPLIERS = 'profile AS (SELECT l_suppkey AS "user", p_brand AS item, CAST(count(*) AS DOUBLE) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)'


def raw_triples(tx):
    return tx.select(F.col("customer_id").alias("user"), F.col("item_id").alias("item"), F.col("item_qty").alias("value"))


def order_weights(tx):
    """Orders that hold both items, per 1000."""
    ones = tx.select(F.col("transaction_id").alias("user"), F.col("item_id").alias("item")).distinct().withColumn("value", F.lit(1.0))
    return elastic.gram(ones).filter("i <> j").select(F.col("i").alias("item_from"), F.col("j").alias("item_to"), (F.col("g") / 1000.0).alias("weight"))


def supplier_profiles(spark, d):
    lines, part = table(spark, d, "lineitem"), table(spark, d, "part")
    joined = lines.join(part, lines["l_partkey"] == part["p_partkey"])
    return joined.groupBy(F.col("l_suppkey").alias("user"), F.col("p_brand").alias("item")).agg(F.count(F.lit(1)).cast("double").alias("value"))


def brand_scores(spark, d):
    """(profiles, scores) of customers over brands."""
    tx = stored_transactions(spark, d, ["customer_id", "item_id", "transaction_id", "item_qty"])
    profile = materialise(R.build_urm(raw_triples(tx)), "profile")
    return profile, R.score_item_based(profile, order_weights(tx))


PARTS = 'profile AS (SELECT o_custkey AS "user", l_partkey AS item, CAST(count(*) AS DOUBLE) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)'
BRANDS = 'profile AS (SELECT customer_id AS "user", item_id AS item, CAST(count(*) AS DOUBLE) AS value FROM tx GROUP BY ALL)'


@register("gram", ctes(PARTS) + """SELECT x.item AS i, y.item AS j, sum(x.value * y.value) AS g FROM profile x JOIN profile y ON x."user" = y."user" GROUP BY ALL""", ["g"], 2)
def gram(spark, d):
    """Parts bought by the same customers."""
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return elastic.gram(joined.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).agg(F.count(F.lit(1)).cast("double").alias("value")))


@register("build_urm", ctes(TX, PROFILE) + "SELECT * FROM profile", ["value"], 6)
def build_urm(spark, d):
    return R.build_urm(raw_triples(transactions(spark, d)))


BRAND_TOTALS = "totals AS (SELECT customer_id, item_id, sum(item_qty) AS qty FROM tx GROUP BY ALL)"
ENCODED = """enc AS (SELECT customer_id AS "user", index AS item, qty AS value FROM totals JOIN idx USING (item_id) WHERE customer_id <> 0)"""
INDEX = "idx AS (SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) AS index FROM totals WHERE customer_id <> 0 GROUP BY item_id)"
EVERYONE = f'everyone AS (SELECT * FROM enc UNION ALL SELECT DISTINCT "user", {R.INTERCEPT}, {R.INTERCEPT_VALUE} FROM enc)'


def brand_totals(spark, d):
    """Quantity per customer and brand, the shape of a category-count file."""
    return transactions(spark, d).groupBy(F.col("customer_id").alias("user"), F.col("item_id").alias("item")).agg(F.sum("item_qty").alias("value"))


def prepared(spark, d):
    return R.slim_prepare(materialise(brand_totals(spark, d), "totals"))


@register("add_intercept", ctes(TX, BRAND_TOTALS, INDEX, ENCODED, EVERYONE) + "SELECT * FROM everyone", ["value"], 2)
def add_intercept(spark, d):
    return prepared(spark, d)[1]


@register("slim_prepare", ctes(TX, BRAND_TOTALS, INDEX, ENCODED, EVERYONE) + """SELECT "user", item, sum(ln(value + 0.1)) AS value FROM
 (SELECT * FROM everyone QUALIFY count(*) OVER (PARTITION BY "user") > 15) GROUP BY ALL""", ["value"], 6)
def slim_prepare(spark, d):
    return prepared(spark, d)[0]


@register("slim_fit")
def slim_fit(spark, d):
    weights, _ = elastic.slim_fit(materialise(prepared(spark, d)[0], "urm"))
    return weights


@register("slim_fit_status", ctes(TX, BRAND_TOTALS, INDEX) + f"SELECT index AS item, true AS converged FROM idx UNION ALL SELECT {R.INTERCEPT}, true")
def slim_fit_status(spark, d):
    _, status = elastic.slim_fit(materialise(prepared(spark, d)[0], "urm"))
    return status.select("item", "converged")


@register("slim_kkt", ctes(TX, BRAND_TOTALS, INDEX) + f"SELECT index AS target, true AS optimal FROM idx UNION ALL SELECT {R.INTERCEPT}, true")
def slim_kkt(spark, d):
    """Optimality of every fitted column, working sets grown eight items at a time."""
    urm = materialise(prepared(spark, d)[0], "urm")
    weights, _ = elastic.slim_fit(urm, width=8)
    return elastic.kkt_residuals(urm, weights).select("target", (F.col("violation") < 1e-6).alias("optimal"))


@register("slim_score")
def slim_score(spark, d):
    urm, everyone, index = prepared(spark, d)
    urm = materialise(urm, "urm")
    weights, _ = elastic.slim_fit(urm)
    return R.slim_score(everyone, weights, index, urm.select("item").distinct())


@register("topk_weights", ctes(TX, ORDERS, WEIGHTS) + "SELECT item_from, item_to, weight FROM weights QUALIFY row_number() OVER (PARTITION BY item_to ORDER BY weight DESC, item_from) <= 5", ["weight"], 6)
def topk_weights(spark, d):
    return R.topk_weights(order_weights(stored_transactions(spark, d)), 5)


@register("score_item_based", ctes(TX, PROFILE, ORDERS, WEIGHTS, SCORES) + "SELECT * FROM scores", ["score"])
def score_item_based(spark, d):
    return brand_scores(spark, d)[1]


@register("score_items", ctes(TX, BRANDS, ORDERS, WEIGHTS, SCORES) + "SELECT * FROM scores", ["score"])
def score_items(spark, d):
    tx = stored_transactions(spark, d)
    profile = tx.groupBy(F.col("customer_id").alias("user"), F.col("item_id").alias("item")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return R.score_items(profile, order_weights(tx))


@register("score_user_based", ctes(SUPPLIERS) + """, a AS (SELECT x."user" AS user_from, y."user" AS user_to, sum(x.value * y.value) AS weight FROM profile x JOIN profile y USING (item)
 WHERE x."user" <> y."user" GROUP BY ALL), w AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY user_from ORDER BY weight DESC, user_to) <= 20)
 SELECT user_from AS "user", item, sum(weight * value) AS score FROM w JOIN profile ON "user" = user_to GROUP BY user_from, item""", ["score"], 2)
def score_user_based(spark, d):
    """Suppliers by the brands they deliver, each scored from its 20 nearest ones."""
    profile = materialise(supplier_profiles(spark, d), "profile")
    turned = profile.select(F.col("item").alias("user"), F.col("user").alias("item"), "value")
    near = R.topk_weights(elastic.gram(turned, strongest=20).filter("i <> j").select(F.col("i").alias("item_from"), F.col("j").alias("item_to"), F.col("g").alias("weight")), 20)
    return R.score_user_based(profile, near.select(F.col("item_to").alias("user_from"), F.col("item_from").alias("user_to"), "weight"))


RANKED = 'row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item)'


@register("recommend", ctes(TX, PROFILE, ORDERS, WEIGHTS, SCORES) + f"""SELECT "user", item, score, rank FROM (SELECT *, {RANKED} AS rank FROM scores) WHERE rank <= 10""", ["score"])
def recommend(spark, d):
    return R.recommend(brand_scores(spark, d)[1], 10)


@register("recommend_unseen", ctes(TX, PROFILE, ORDERS, WEIGHTS, SCORES) + f"""SELECT "user", item, score, rank FROM (SELECT *, {RANKED} AS rank FROM scores s
 WHERE NOT EXISTS (SELECT 1 FROM profile p WHERE p."user" = s."user" AND p.item = s.item)) WHERE rank <= 24""", ["score"])
def recommend_unseen(spark, d):
    profile, scores = brand_scores(spark, d)
    return R.recommend(scores, 24, seen=profile)


@register("recommend_filtered", ctes(TX, PROFILE, ORDERS, WEIGHTS, SCORES) + f"""SELECT "user", item, score, rank FROM (SELECT *, {RANKED} AS rank FROM scores
 WHERE item IN ({TARGET_LIST}) AND item NOT IN ('Brand#1', 'Brand#2') AND item NOT IN (SELECT item_id FROM tx GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 3)
 AND "user" IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')) WHERE rank <= 5""", ["score"])
def recommend_filtered(spark, d):
    """Candidate list, ignore list, popular items removed, chosen users, with scores."""
    tx = stored_transactions(spark, d)
    scores = R.score_item_based(R.build_urm(raw_triples(tx)), order_weights(tx))
    brands = tx.select(F.col("item_id").alias("item")).distinct()
    users = table(spark, d, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("user"))
    return R.recommend(scores, 5, items=brands.filter(F.col("item").isin(*TARGETS)), ignore=brands.filter(F.col("item").isin("Brand#1", "Brand#2")),
                       remove_top_pop=3, interactions=raw_triples(tx), users=users)


@register("recommend_lists", ctes(TX, PROFILE, ORDERS, WEIGHTS, SCORES) + f"""SELECT "user", string_agg(item, '|' ORDER BY rank) AS items FROM (SELECT *, {RANKED} AS rank FROM scores) WHERE rank <= 10 GROUP BY "user" """)
def recommend_lists(spark, d):
    lists = R.as_lists(R.recommend(brand_scores(spark, d)[1], 10))
    return lists.select("user", F.array_join("items", "|").alias("items"))


@register("recommend_zero_tail", ctes(SUPPLIERS) + f"""SELECT "user", item, score, rank FROM (SELECT *, {RANKED} AS rank FROM (SELECT s_suppkey AS "user", b.item, coalesce(value, 0) AS score
 FROM supplier CROSS JOIN (SELECT unnest([{TARGET_LIST}]) AS item) b LEFT JOIN (SELECT * FROM profile WHERE item IN ({TARGET_LIST})) p ON p."user" = s_suppkey AND p.item = b.item)) WHERE rank <= 8""", ["score"])
def recommend_zero_tail(spark, d):
    known = supplier_profiles(spark, d).filter(F.col("item").isin(*TARGETS)).select("user", "item", F.col("value").alias("score"))
    users = table(spark, d, "supplier").select(F.col("s_suppkey").alias("user"))
    return R.recommend(R.with_zero_tail(known, users, TARGETS), 8)


# Three prediction tables over the same customers: shares of amount, of quantity and of rows per target.
COLUMNS = [f"Target_{t}" for t in TARGETS]


def _share_sql(measure: str) -> str:
    cells = ", ".join(f"""coalesce(sum({measure}) FILTER (WHERE item_id = '{t}'), 0) / sum({measure}) AS "Target_{t}" """ for t in TARGETS)
    return f"SELECT customer_id, {cells} FROM tx GROUP BY customer_id"


def _share(tx, measure):
    return tx.groupBy("customer_id").agg(*[(F.coalesce(F.sum(F.when(F.col("item_id") == t, measure)), F.lit(0)) / F.sum(measure)).alias(f"Target_{t}") for t in TARGETS])


PREDICTIONS = (f"a AS ({_share_sql('item_amt')})", f"q AS ({_share_sql('item_qty')})", f"n AS ({_share_sql('1')})")


def predictions(spark, d):
    tx = stored_transactions(spark, d)
    return [_share(tx, F.col("item_amt")), _share(tx, F.col("item_qty")), _share(tx, F.lit(1))]


@register("blend", ctes(TX, *PREDICTIONS) + "SELECT customer_id, " + ", ".join(f'0.4 * a."{c}" + 0.2 * q."{c}" + 0.4 * n."{c}" AS "{c}"' for c in COLUMNS)
          + " FROM a JOIN q USING (customer_id) JOIN n USING (customer_id)", COLUMNS, 6)
def blend(spark, d):
    return R.blend(predictions(spark, d), (0.4, 0.2, 0.4), ["customer_id"], COLUMNS)


@register("align", ctes(TX, *PREDICTIONS) + "SELECT customer_id, " + ", ".join(f'{t}."{c}" AS "{c}__{i}"' for i, t in enumerate("aqn") for c in COLUMNS)
          + " FROM a JOIN q USING (customer_id) JOIN n USING (customer_id)", [f"{c}__{i}" for i in range(3) for c in COLUMNS], 6)
def align(spark, d):
    return R.align(predictions(spark, d), ["customer_id"], COLUMNS)


@register("average_folds", ctes(TX) + """, p AS (SELECT customer_id, CAST(transaction_id % 10 AS INTEGER) AS fold, avg(item_amt) AS p FROM tx GROUP BY ALL),
 f AS (SELECT CAST(transaction_id % 10 AS INTEGER) AS fold, avg(CASE WHEN item_qty > 10 THEN 1.0 ELSE 0.0 END) AS accuracy FROM tx GROUP BY ALL)
 SELECT customer_id, avg(p) AS p FROM p WHERE fold IN (SELECT fold FROM f WHERE accuracy > 0.79) GROUP BY customer_id""", ["p"])
def average_folds(spark, d):
    tx = stored_transactions(spark, d).withColumn("fold", (F.col("transaction_id") % 10).cast("int"))
    folds = tx.groupBy("fold").agg(F.avg(F.when(F.col("item_qty") > 10, 1.0).otherwise(0.0)).alias("accuracy"))
    return R.average_folds(tx.groupBy("customer_id", "fold").agg(F.avg("item_amt").alias("p")), folds, ["customer_id"], ["p"])


@register("override_known", """SELECT o_orderkey, o_custkey, coalesce(mode, o_orderpriority) AS o_orderpriority FROM orders LEFT JOIN (SELECT o_custkey, o_orderpriority AS mode FROM orders
 WHERE o_orderstatus = 'P' GROUP BY o_custkey, o_orderpriority QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) = 1) USING (o_custkey)""")
def override_known(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    known = group_mode(orders.filter("o_orderstatus = 'P'"), "o_custkey", "o_orderpriority", "o_orderpriority")
    return R.override_known(orders.drop("o_orderstatus"), known, "o_custkey", "o_orderpriority")


COLD_TRAIN = labels_sql("tx", ["customer_id"], TARGETS)


@register("cold_start", ctes(TX, *PREDICTIONS[:1]) + f""", t AS ({COLD_TRAIN}), rates AS (SELECT {', '.join(f'avg("{c}") AS "{c}"' for c in COLUMNS)} FROM t),
 known AS (SELECT * FROM a WHERE customer_id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000))
 SELECT c_custkey AS customer_id, {', '.join(f'CASE WHEN k.customer_id IS NULL THEN {fixed} ELSE k."{c}" END AS "{c}"' for c, fixed in zip(COLUMNS, ["1.0", "0.9", *[f'rates."{c}"' for c in COLUMNS[2:]]]))}
 FROM customer CROSS JOIN rates LEFT JOIN known k ON k.customer_id = c_custkey""", COLUMNS, 6)
def cold_start(spark, d):
    tx = stored_transactions(spark, d)
    buyers = table(spark, d, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("customer_id"))
    known = _share(tx, F.col("item_amt")).join(buyers, "customer_id", "left_semi")
    template = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"))
    return scoring.cold_start(known, template, labels(tx, TARGETS), COLUMNS, {COLUMNS[0]: 1.0, COLUMNS[1]: 0.9})
