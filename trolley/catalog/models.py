"""Estimators. Iterative fits have no SQL; the closed-form ones do."""

from __future__ import annotations

import re

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trolley.catalog.base import SEED, TARGETS, TX, ctes, labels_sql, register, stored_transactions, table, texts
from trolley.catalog.texts import TOKENS, VOCAB, _grams, tfidf_ctes
from trolley.functions import text as X
from trolley.operators import metrics, models as M, rfm
from trolley.operators.feature_config import fit_config, load_config
from trolley.operators.recommend import average_folds
from trolley.operators.reshape import labels
from trolley.operators.sampling import kfold, split
from trolley.operators.sparse import as_vectors, assemble_sparse, block, from_vectors, ridge
from trolley.operators.summary import bounds, encode_ids, implicit_rating
from trolley.operators.text import term_counts, tfidf_fit, tfidf_transform
from trolley.functions.dates import reference_date, time_literal
from trolley.plans import frames, scoring, universe as U
from trolley.session import materialise, scratch_path

MODEL_TARGETS = [f"Target_{t}" for t in TARGETS]
KEY = ["customer_id"]


def behaviour(spark, d):
    """(training rows, scoring rows, feature names): customer RFM and recency, scaled to [0, 1],
    with next-year labels; scoring rows are dated a year later."""
    tx = stored_transactions(spark, d)
    now, then = reference_date(tx), reference_date(tx, days=360)

    def features(ref):
        past = tx.filter(F.col("InvoiceDate") <= time_literal(ref))
        blocks = rfm.customer_rfm(past, rfm.WINDOWS_LONG, ref).join(rfm.recency(past, ref, KEY, "T"), KEY, "right")
        return blocks.na.fill(rfm.PENALTY)

    known = features(then)
    names = [c for c in known.columns if c not in KEY]
    later = labels(tx.filter(F.col("InvoiceDate") > time_literal(then)), TARGETS)
    train = materialise(known.join(later, KEY, "left").na.fill(0, MODEL_TARGETS), "train")
    score = features(now)
    return M.minmax(train, names), M.minmax(train, names, score), names


def vectors(df, names):
    return VectorAssembler(inputCols=list(names), outputCol="features").transform(df)


def ready(spark, d):
    train, score, names = behaviour(spark, d)
    kept = [*KEY, "features", *MODEL_TARGETS]
    return materialise(vectors(train, names).select(*kept), "ready"), vectors(score, names).select(*KEY, "features")


@register("fit_per_target")
def fit_per_target(spark, d):
    train, score = ready(spark, d)
    return M.fit_per_target(train, score, MODEL_TARGETS, KEY)


@register("fit_per_target_balanced")
def fit_per_target_balanced(spark, d):
    """Under-sampled classes, selected features."""
    train, score = ready(spark, d)
    return M.fit_per_target(train, score, MODEL_TARGETS, KEY, select=True, balance=SEED)


@register("select_by_coef")
def select_by_coef(spark, d):
    train, _ = ready(spark, d)
    return spark.createDataFrame([(i,) for i in M.select_by_coef(train, MODEL_TARGETS[0])], "feature int")


@register("grid_search")
def grid_search(spark, d):
    train, _ = ready(spark, d)
    fitted = M.grid_search(train, MODEL_TARGETS[0])
    return spark.createDataFrame([(c, float(a)) for c, a in zip(M.GRID_C, fitted.avgMetrics)], "c double, accuracy double")


@register("fit_forest")
def fit_forest(spark, d):
    train, score = ready(spark, d)
    return M.fit_forest(train, score, MODEL_TARGETS, KEY)


@register("fit_long")
def fit_long(spark, d):
    rows = materialise(U.universe_long(stored_transactions(spark, d), TARGETS).rows, "long")
    names = [c for c in rows.columns if c not in ("origin", "customer_id", "item_id", "Target", "IMPP")]
    train, score = rows.filter("origin > 1"), rows.filter("origin = 1")
    return M.fit_long(train, score, names, ["customer_id", "item_id"])


@register("family_models")
def family_models(spark, d):
    """Four families of the rolling frame's columns, one set of models each, equally blended: windows alone,
    terms alone, windows with the targets' terms, everything."""
    tx = stored_transactions(spark, d)
    train, frame = frames.fit_rolling(tx, TARGETS)
    train = materialise(train, "train")
    score = materialise(frames.score(frame, tx, table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"))), "score")
    fitted = M.family_models(train, score, M.column_families(frame.columns, TARGETS), MODEL_TARGETS, KEY)
    return scoring.family_blend(list(fitted.values()), MODEL_TARGETS)


@register("fit_per_target_check", ctes(TX, 'ref AS (SELECT max("InvoiceDate") - INTERVAL 360 DAY AS rd FROM tx)', 'past AS (SELECT DISTINCT customer_id FROM tx, ref WHERE "InvoiceDate" <= rd)',
          f"""later AS ({labels_sql('(SELECT * FROM tx, ref WHERE "InvoiceDate" > rd)', KEY)})""")
          + " UNION ALL ".join(f"""SELECT '{t}' AS target, count(*) AS n, avg(coalesce("{t}", 0)) AS mean_probability, true AS stationary FROM past LEFT JOIN later USING (customer_id)""" for t in MODEL_TARGETS),
          ["mean_probability"], 5)
def fit_per_target_check(spark, d):
    """At the optimum the free intercept makes mean probability and base rate equal, and every feature's
    residual sum equals its penalty term: ``stationary`` recomputes that from the predictions."""
    train, _ = ready(spark, d)
    model = M.fit_targets(train, MODEL_TARGETS)
    rows = from_vectors(train)
    scored = model.predict(rows.withColumns({"x": F.col("values")}), [f"p_{t}" for t in MODEL_TARGETS], logistic=True)
    off = [F.col(f"p_{t}") - F.col(f"`{t}`") for t in MODEL_TARGETS]
    per = materialise(scored.select("x", F.array(*off).alias("off"), F.array(*[F.col(f"p_{t}") for t in MODEL_TARGETS]).alias("p")), "scored")
    cells = per.select(F.posexplode("x").alias("j", "v"), "off")
    slopes = cells.groupBy("j").agg(*[F.sum(F.col("v") * F.col("off")[t]).alias(f"g{t}") for t in range(len(MODEL_TARGETS))]).collect()  # a row per feature
    n = per.count()
    worst = [max(abs(r[f"g{t}"] + model.weights[r["j"], t]) for r in slopes) / n for t in range(len(MODEL_TARGETS))]
    means = per.agg(*[F.avg(F.col("p")[t]).alias(f"m{t}") for t in range(len(MODEL_TARGETS))]).first()
    return spark.createDataFrame([(t, n, means[f"m{i}"], bool(worst[i] < 1e-6)) for i, t in enumerate(MODEL_TARGETS)], "target string, n long, mean_probability double, stationary boolean")


PART_WORDS = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]+')"


def _part_terms(column: str) -> str:
    return f"SELECT doc, term, count(*) AS tf FROM ({_grams(f'SELECT p_partkey AS doc, {PART_WORDS.format(c=column)} AS w FROM part')}) GROUP BY ALL"


def _part_ctes() -> list[str]:
    out = []
    for name in ("p_name", "p_type"):
        steps = tfidf_ctes(_part_terms(name), "SELECT count(*) FROM part", 2)
        for old in ("counts", "vocab", "raw", "weights"):
            steps = [re.sub(rf"\b{old}\b", f"{name}_{old}", s) for s in steps]
        out += [*steps, f"{name}_no AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS i FROM {name}_vocab)"]
    return out


def part_features(spark, d):
    """(parts with sparse entries, their number): 1- to 3-grams of name and type that two parts hold, then the size."""
    part = table(spark, d, "part")
    documents, blocks = part.count(), []
    for name in ("p_name", "p_type"):
        counts = term_counts(part, ["p_partkey"], name, lambda t: X.words(t, X.WORDS_1PLUS), (1, 2, 3))
        model = tfidf_fit(counts, documents, 2)
        blocks.append(block(tfidf_transform(model, counts, ["p_partkey"]), model.vocabulary))
    return assemble_sparse(part.select("p_partkey", "p_size", "p_retailprice"), ["p_partkey"], blocks, ["p_size"])


@register("assemble_sparse", ctes(*_part_ctes()) + """SELECT p_partkey, count(*) AS entries, sum(v * (i + 1)) AS checksum FROM (
 SELECT doc AS p_partkey, i, weight AS v FROM p_name_weights JOIN p_name_no USING (term) UNION ALL
 SELECT doc, i + (SELECT count(*) FROM p_name_no), weight FROM p_type_weights JOIN p_type_no USING (term) UNION ALL
 SELECT p_partkey, (SELECT count(*) FROM p_name_no) + (SELECT count(*) FROM p_type_no), p_size FROM part WHERE p_size <> 0) GROUP BY p_partkey""", ["checksum"])
def assemble_sparse_rows(spark, d):
    """Text blocks and a number in one sparse vector; checked by its number of entries and a weighted sum."""
    rows, size = part_features(spark, d)
    vectors = as_vectors(rows.select("p_partkey", "indices", "values"), size)
    entries = vectors.select("p_partkey", F.posexplode(vector_to_array("features")).alias("i", "v")).filter("v <> 0")
    return entries.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("entries"), F.sum(F.col("v") * (F.col("i") + 1)).alias("checksum"))


@register("fit_ridge_text", ctes(*_part_ctes()) + """SELECT count(*) AS n, (SELECT count(*) FROM p_name_no) + (SELECT count(*) FROM p_type_no) + 1 AS features,
 avg(p_retailprice) AS mean_prediction, true AS solved FROM part""", ["mean_prediction"])
def fit_ridge_text(spark, d):
    """Price from name, type and size. ``solved``: every feature's residual sum equals its penalty term, to
    1e-6 of the summed prices; the free intercept makes mean prediction and mean price equal."""
    rows, size = part_features(spark, d)
    rows = materialise(rows, "parts")
    model = ridge(rows, ["p_retailprice"], size)
    scored = materialise(model.predict(rows.withColumn("e", F.arrays_zip("indices", "values")), ["prediction"]), "scored")
    slopes = (scored.select(F.explode("e").alias("e"), (F.col("p_retailprice") - F.col("prediction")).alias("off"))
              .groupBy("e.indices").agg(F.sum(F.col("e.values") * F.col("off")).alias("g")).collect())  # a row per feature
    found = scored.agg(F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("m"), F.sum("p_retailprice").alias("s")).first()
    worst = max(abs(r["g"] - model.weights[r["indices"], 0]) for r in slopes)
    return spark.createDataFrame([(found["n"], size, found["m"], bool(worst < 1e-6 * max(found["s"], 1.0)))], "n long, features long, mean_prediction double, solved boolean")


@register("assemble_mixed", """WITH t AS (SELECT DISTINCT 'c_mktsegment=' || c_mktsegment AS term FROM customer), no AS (SELECT term, row_number() OVER (ORDER BY term) AS i FROM t)
 SELECT c_custkey, i + (c_nationkey * ((SELECT count(*) FROM no) + 1)) + (c_acctbal * ((SELECT count(*) FROM no) + 2)) AS checksum FROM customer JOIN no ON term = 'c_mktsegment=' || c_mktsegment""", ["checksum"], 2)
def assemble_mixed(spark, d):
    """Columns split by type: one entry per category, then the numbers; checked by a weighted sum."""
    rows = M.assemble([table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")], ["c_custkey"])
    entries = rows.select("c_custkey", F.posexplode(vector_to_array("features")).alias("i", "v"))
    return entries.groupBy("c_custkey").agg(F.sum(F.col("v") * (F.col("i") + 1)).alias("checksum"))


@register("stored_features", ctes(VOCAB, f"flat AS (SELECT item_id, unnest({TOKENS}) AS token, generate_subscripts({TOKENS}, 1) AS pos FROM benchmark)") + """
SELECT item_id, array_to_string(list_concat(coalesce(ids, []), list_resize([]::BIGINT[], CAST(60 - len(coalesce(ids, [])) AS BIGINT), 0)), ' ') AS ids,
 (length(text) - (SELECT min(n_chars) FROM documents)) / (SELECT max(n_chars) - min(n_chars) FROM documents)::DOUBLE AS size
FROM benchmark LEFT JOIN (SELECT item_id, list(id ORDER BY pos) AS ids FROM (SELECT item_id, pos, id,
 row_number() OVER (PARTITION BY item_id ORDER BY pos DESC) AS back FROM flat JOIN vocab USING (token)) WHERE back <= 60 GROUP BY ALL) USING (item_id)""", ["size"], 6)
def stored_features(spark, d):
    """Dictionary, padding length, columns and range fitted on one table, stored, read back and applied to another."""
    path = scratch_path(spark, "config")
    fit_config(texts(spark, d), ["text"], ["n_chars"]).save(spark, path)
    items = texts(spark, d, "benchmark").withColumn("n_chars", F.length("text"))
    found = load_config(spark, path).apply(items, ["item_id"])
    return found.select("item_id", F.array_join("text", " ").alias("ids"), F.col("n_chars").alias("size"))


@register("fit_ridge", """WITH s AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice) AS my,
 var_pop(l_quantity) * count(*) + 1.0 AS xx, var_pop(l_discount) * count(*) + 1.0 AS zz, covar_pop(l_quantity, l_discount) * count(*) AS xz,
 covar_pop(l_quantity, l_extendedprice) * count(*) AS xy, covar_pop(l_discount, l_extendedprice) * count(*) AS zy FROM lineitem),
 w AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS wx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS wz FROM s)
 SELECT 'l_quantity' AS feature, wx AS weight FROM w UNION ALL SELECT 'l_discount', wz FROM w UNION ALL SELECT 'intercept', my - wx * mx - wz * mz FROM w""", ["weight"], 3)
def fit_ridge(spark, d):
    lines = vectors(table(spark, d, "lineitem"), ["l_quantity", "l_discount"])
    model = M.fit_ridge(lines, "l_extendedprice")
    rows = [("l_quantity", float(model.weights[0, 0])), ("l_discount", float(model.weights[1, 0])), ("intercept", float(model.intercepts[0]))]
    return spark.createDataFrame(rows, "feature string, weight double")


@register("fit_boosted")
def fit_boosted(spark, d):
    """Order status from its price and month, one probability per class, for orders not trained on."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.month("o_orderdate").alias("month"),
                                              F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("label"))
    rows = materialise(vectors(orders, ["o_totalprice", "month"]).select("o_orderkey", "features", "label"), "orders")
    train, held = split(rows, 0.2, SEED + 1, ["o_orderkey"])  # another draw than the early-stopping one
    return M.fit_boosted(materialise(train, "train"), held.drop("label"), "label", (0, 1, 2), ["o_orderkey"])


def ratings(spark, d):
    """(ratings with integer ids, customer dictionary, item dictionary) over customers and parts."""
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    tx = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("item_id"), F.col("l_orderkey").alias("transaction_id"))
    rated = materialise(implicit_rating(tx), "ratings")
    users, items = encode_ids(rated, "customer_id", "user"), encode_ids(rated, "item_id", "item")
    coded = rated.join(users, "customer_id").join(items, "item_id")
    return materialise(coded.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), "rating"), "coded"), users, items


@register("fit_factors")
def fit_factors(spark, d):
    """Loss of the factor model on the training and the held-out ratings."""
    coded, _, _ = ratings(spark, d)
    train, held = split(coded, 0.1, SEED, ["user", "item"])
    edge = bounds(coded, "rating").first()
    model = M.fit_factors(train)
    scored = [(n, M.clip_ratings(model.transform(t), edge["min"], edge["max"])) for n, t in (("train", train), ("held", held))]
    losses = [(n, s.agg(metrics.mse("rating", "prediction").alias("m")).first()["m"]) for n, s in scored]
    return spark.createDataFrame(losses, "part string, mse double")


@register("recommend_all")
def recommend_all(spark, d):
    coded, users, items = ratings(spark, d)
    edge = bounds(coded, "rating").first()
    best = M.recommend_all(M.fit_factors(coded), 10, edge["min"], edge["max"])
    return (best.join(users, "user").join(items, "item")
            .select("customer_id", "item_id", F.col("prediction").cast("double").alias("prediction"), "rank"))


@register("average_fold_models")
def average_fold_models(spark, d):
    """Ten contiguous folds: one model each, averaged over the folds that pass the gate."""
    train, score = ready(spark, d)
    target, folded = MODEL_TARGETS[0], materialise(kfold(train, 10, [F.asc("customer_id")]), "folds")
    accuracies, predictions = [], None
    sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    for fold in range(10):
        model = M.logistic(1.0, sum(n for f, n in sizes.items() if f != fold), target).fit(folded.filter(F.col("fold") != fold))
        held = model.transform(folded.filter(F.col("fold") == fold))
        accuracies.append((fold, held.agg(metrics.accuracy(target, "prediction").alias("a")).first()["a"]))
        scored = model.transform(score).select(*KEY, F.lit(fold).alias("fold"), M.positive_probability().alias(target))
        predictions = scored if predictions is None else predictions.unionByName(scored)
    folds = spark.createDataFrame(accuracies, "fold int, accuracy double")
    return average_folds(predictions, folds, KEY, [target], gate=0.5)


@register("permutation_importance")
def permutation_importance(spark, d):
    train, _, names = behaviour(spark, d)
    rows = materialise(train, "importance")
    model = M.logistic(1.0, rows.count(), MODEL_TARGETS[0]).fit(vectors(rows, names))
    return M.permutation_importance(rows, model, names, MODEL_TARGETS[0], KEY, SEED)


@register("permuted", """WITH a AS (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_custkey) AS i, row_number() OVER (ORDER BY md5(CAST(c_custkey AS VARCHAR) || ':42')) AS j FROM customer)
 SELECT x.c_custkey, x.c_acctbal, y.c_acctbal AS perm_c_acctbal FROM a x JOIN a y ON x.i = y.j""")
def permuted(spark, d):
    return M.permuted(table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_custkey"], ["c_acctbal"], SEED)


@register("assemble", """SELECT c_custkey, c_acctbal + coalesce(n, 0) * 1000 AS checksum FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders
 WHERE o_orderstatus = 'P' GROUP BY o_custkey) USING (c_custkey)""", ["checksum"], 2)
def assemble(spark, d):
    """Blocks joined to one vector; checked by a weighted sum of its entries."""
    orders = table(spark, d, "orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = M.assemble([table(spark, d, "customer").select("c_custkey", "c_acctbal"), orders], ["c_custkey"])
    parts = vector_to_array("features")
    return rows.select("c_custkey", (parts[0] + parts[1] * 1000).alias("checksum"))
