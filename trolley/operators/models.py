"""Estimators on assembled feature tables (MLlib) and scaling."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, Window as W, functions as F

from trolley.functions.draws import draw_order
from trolley.operators.metrics import accuracy, binary_cross_entropy
from trolley.operators.ordering import number_rows
from trolley.operators.sampling import split, undersample
from trolley.operators.sparse import Linear, as_vectors, assemble_sparse, block as sparse_block, categories, column_kinds, from_vectors, logistic as logistic_fit, only, ridge, without_zeros
from trolley.session import materialise, shared_dir

# Regularisation grid and forest depth.
GRID_C = (0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05, 0.01)
FOREST_DEPTH = 8


def minmax(train: DataFrame, columns: Sequence[str], apply_to: DataFrame | None = None) -> DataFrame:
    """Scale to [0, 1] by the training range (one row to the driver); a constant column becomes 0."""
    low_high = train.agg(*[f(F.col(f"`{c}`")).alias(f"{f.__name__}{i}") for i, c in enumerate(columns) for f in (F.min, F.max)]).first()
    out = {}
    for i, c in enumerate(columns):
        low, high = float(low_high[f"min{i}"]), float(low_high[f"max{i}"])
        out[c] = (F.col(f"`{c}`") - low) / ((high - low) or 1.0)
    return (train if apply_to is None else apply_to).withColumns(out)


def standardise(train: DataFrame, columns: Sequence[str], apply_to: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation by the training rows; constant columns are only centred."""
    stats = train.agg(*[f(F.col(f"`{c}`")).alias(f"{f.__name__}{i}") for i, c in enumerate(columns) for f in (F.avg, F.stddev_pop)]).first()
    out = {}
    for i, c in enumerate(columns):
        out[c] = (F.col(f"`{c}`") - float(stats[f"avg{i}"])) / (float(stats[f"stddev_pop{i}"]) or 1.0)
    return (train if apply_to is None else apply_to).withColumns(out)


def assemble(blocks: Sequence[DataFrame], key: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Feature blocks joined on their key, missing entries 0, as one vector column.

    Columns are split by type: categorical ones become one entry per value, in the order of
    ``<column>=<value>``, ahead of the numeric ones, and the vector is sparse then.
    """
    joined = blocks[0]
    for block in blocks[1:]:
        joined = joined.join(block, list(key), "left")
    names = list(columns or [c for c in joined.columns if c not in key])
    categorical, numeric = column_kinds(joined.select(*[F.col(f"`{c}`") for c in names]))
    if not categorical:
        return VectorAssembler(inputCols=names, outputCol="features").transform(joined.na.fill(0, names))
    joined = materialise(joined.na.fill(0, numeric), "joined")
    rows, size = assemble_sparse(joined, key, [sparse_block(categories(joined, key, categorical))], numeric)
    return as_vectors(rows, size)


def logistic(c: float, n: int, label: str, features: str = "features") -> LogisticRegression:
    """L2 logistic regression whose penalty 1/(2 C n) |w|^2 matches an inverse strength C on summed loss."""
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (c * n), elasticNetParam=0.0,
                              standardization=False, maxIter=100)


def select_by_coef(train: DataFrame, label: str, features: str = "features") -> list[int]:
    """Positions of features whose |coefficient| reaches the mean |coefficient| of a plain fit."""
    size = [abs(x) for x in logistic(1.0, train.count(), label, features).fit(train).coefficients]
    mean = sum(size) / len(size)
    return [i for i, x in enumerate(size) if x >= mean]


def slice_features(df: DataFrame, keep: Sequence[int], features: str = "features", out: str = "selected") -> DataFrame:
    return VectorSlicer(inputCol=features, outputCol=out, indices=list(keep)).transform(df)


def positive_probability(column: str = "probability"):
    return vector_to_array(F.col(column))[1]


def _score(model: Model, df: DataFrame, name: str) -> DataFrame:
    return (model.transform(df).withColumn(name, positive_probability())
            .drop("rawPrediction", "probability", "prediction"))


def fit_targets(train: DataFrame, targets: Sequence[str], c: float = 1.0, tolerance: float = 1e-9, scans: int = 500) -> Linear:
    """One logistic model per target over all features, fitted together: each step is one scan. The mean of a
    target's probabilities is its base rate up to ``tolerance``."""
    rows = from_vectors(train.select("features", *[F.col(f"`{t}`") for t in targets]))
    size = rows.agg(F.max(F.size("values"))).first()[0] or 0
    return logistic_fit(materialise(without_zeros(rows), "entries"), targets, size, c, tolerance, scans)


def fit_per_target(train: DataFrame, score: DataFrame, targets: Sequence[str], key: Sequence[str], c: float = 1.0,
                   select: bool = False, balance: int | None = None) -> DataFrame:
    """One logistic model per target; probabilities of all targets in one pass over ``score``.

    Without options all targets are fitted together. ``select`` keeps the strong features of each target, ``balance`` under-samples the
    larger class (with that seed) first.
    """
    if not select and balance is None:
        return fit_targets(train, targets, c).predict(from_vectors(score.select(*key, "features")), targets, logistic=True)
    out = score
    for target in targets:
        rows = train if balance is None else undersample(train, target, balance, key)
        feats = "features"
        if select:
            keep = select_by_coef(rows, target)
            rows, out, feats = slice_features(rows, keep), slice_features(out, keep), "selected"
        out = _score(logistic(c, rows.count(), target, feats).fit(rows), out, f"p_{target}")
        out = out.drop("selected")
    return out.select(*key, *[F.col(f"`p_{t}`").alias(t) for t in targets])


def grid_search(train: DataFrame, label: str, grid: Sequence[float] = GRID_C, folds: int = 5, seed: int = 0,
                parallelism: int = 4) -> CrossValidatorModel:
    """Cross-validated accuracy over the regularisation grid."""
    model = logistic(1.0, 1, label)
    rows = train.count() * (folds - 1) / folds
    space = ParamGridBuilder().addGrid(model.regParam, [1.0 / (c * rows) for c in grid]).build()
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    found = CrossValidator(estimator=model, estimatorParamMaps=space, evaluator=judge, numFolds=folds, seed=seed,
                           parallelism=parallelism).fit(train)
    # The last fit has all rows, so the chosen strength is another penalty than on a fold's rows.
    best = max(range(len(grid)), key=lambda i: found.avgMetrics[i])
    final = logistic(grid[best], round(rows * folds / (folds - 1)), label).fit(train)
    return CrossValidatorModel(final, avgMetrics=found.avgMetrics)


def fit_forest(train: DataFrame, score: DataFrame, targets: Sequence[str], key: Sequence[str], trees: int = 150,
               subset: str = "auto", seed: int = 50) -> DataFrame:
    """One entropy forest of depth 8 per target; probabilities of all targets."""
    out = score
    for target in targets:
        forest = RandomForestClassifier(featuresCol="features", labelCol=target, numTrees=trees, maxDepth=FOREST_DEPTH,
                                        impurity="entropy", featureSubsetStrategy=subset, seed=seed)
        out = _score(forest.fit(train), out, f"p_{target}")
    return out.select(*key, *[F.col(f"`p_{t}`").alias(t) for t in targets])


def fit_long(train: DataFrame, score: DataFrame, columns: Sequence[str], key: Sequence[str], label: str = "Target",
             c: float = 0.01) -> DataFrame:
    """Long-format classifier: standardise, select, fit, one probability per (customer, item) row."""
    fitted = VectorAssembler(inputCols=list(columns), outputCol="features")
    rows = materialise(fitted.transform(standardise(train, columns)).select(*key, "features", label), "long")
    new = fitted.transform(standardise(train, columns, score)).select(*key, "features")
    return fit_per_target(rows, new, [label], key, c, select=True)


def column_families(columns: Sequence[str], targets: Sequence[str], term: str = "tfidf_", tagged: str = "item_") -> dict[str, list[str]]:
    """The four families of a frame's columns: no terms; terms alone; all but the terms of tagged items
    that are no target; everything."""
    terms = [c for c in columns if c.startswith(term)]
    own = {w for t in targets for w in re.findall(r"[^\W]{2,}", f"{tagged}{t}".lower())}
    other = {c for c in terms if c.startswith(term + tagged) and c[len(term):] not in own}
    return {"windows": [c for c in columns if c not in terms], "terms": terms,
            "target_terms": [c for c in columns if c not in other], "all": list(columns)}


def family_models(train: DataFrame, score: DataFrame, families: dict[str, Sequence[str]], targets: Sequence[str],
                  key: Sequence[str], c: float = 1.0) -> dict[str, DataFrame]:
    """One set of per-target models for each family of feature columns; all targets of a family are fitted
    together, to a mean gradient of 1e-5 or for 100 scans. The columns of all families are scaled and stored once;
    families of the same columns are fitted once."""
    every = list(dict.fromkeys(c for columns in families.values() for c in columns))
    vector = VectorAssembler(inputCols=every, outputCol="features")
    labels = [F.col(f"`{t}`") for t in targets]
    rows = materialise(without_zeros(from_vectors(vector.transform(minmax(train, every)).select("features", *labels))), "family_rows")
    new = materialise(without_zeros(from_vectors(vector.transform(minmax(train, every, score)).select(*key, "features"))), "family_scores")
    out, models = {}, {}
    for name, columns in families.items():
        places = [every.index(c) for c in columns]
        own = tuple(columns)
        if own not in models:
            models[own] = logistic_fit(materialise(only(rows, places, len(every)), name), targets, len(places), c, 1e-5, 100)
        out[name] = models[own].predict(only(new, places, len(every)), targets, logistic=True)
    return out


def fit_ridge(train: DataFrame, label: str, features: str = "features", alpha: float = 1.0) -> Linear:
    """Ridge regression with the penalty alpha |w|^2 on the sum of squares and a free intercept."""
    rows = materialise(from_vectors(train.select(F.col(features).alias("features"), F.col(label).alias("y"))), "entries")
    return ridge(rows, ["y"], rows.agg(F.max(F.size("values"))).first()[0] or 0, alpha)


def fit_boosted(train: DataFrame, score: DataFrame, label: str, classes: Sequence[int], key: Sequence[str],
                rounds: int = 20, frac: float = 0.2, seed: int = 42) -> DataFrame:
    """Class probabilities from one boosted ensemble per class with early stopping on a
    held-out draw, normalised to sum to 1."""
    _, held = split(train.select(*key), frac, seed, key)
    flagged = train.join(held.withColumn("_held", F.lit(True)), list(key), "left").na.fill(False, ["_held"])
    out = score
    for k in classes:
        one = flagged.withColumn("_y", F.when(F.col(label) == k, 1.0).otherwise(0.0))
        model = GBTClassifier(featuresCol="features", labelCol="_y", validationIndicatorCol="_held", maxIter=rounds,
                              maxDepth=6, stepSize=0.1, subsamplingRate=0.7, seed=seed).fit(one)
        out = _score(model, out, f"_p{k}")
    total = sum((F.col(f"_p{k}") for k in classes), F.lit(0.0))
    return out.select(*key, *[(F.col(f"_p{k}") / total).alias(f"p{k}") for k in classes])


def fit_factors(ratings: DataFrame, rank: int = 50, iterations: int = 10, reg: float = 0.05, seed: int = 42) -> ALSModel:
    """Latent factors of (user, item, rating); ids are contiguous integers. Item factors are stored in each
    iteration, and the shuffles before them are dropped then."""
    shared_dir(ratings.sparkSession)  # without a checkpoint folder ALS keeps all shuffles
    return ALS(userCol="user", itemCol="item", ratingCol="rating", rank=rank, maxIter=iterations, regParam=reg,
               coldStartStrategy="drop", seed=seed, checkpointInterval=1).fit(ratings)


def clip_ratings(predicted: DataFrame, low: float, high: float, column: str = "prediction") -> DataFrame:
    """Keep predictions inside the observed rating range."""
    return predicted.withColumn(column, F.greatest(F.least(F.col(column), F.lit(high)), F.lit(low)))


def recommend_all(model: ALSModel, n: int, low: float, high: float) -> DataFrame:
    """The n best items per user, seen items included, with the dense rank of the score."""
    rows = model.recommendForAllUsers(n).select("user", F.posexplode("recommendations").alias("place", "r"))
    clipped = clip_ratings(rows.select("user", F.col("r.item").alias("item"), F.col("r.rating").alias("prediction")), low, high)
    order = W.partitionBy("user").orderBy(F.desc("prediction"))
    return clipped.withColumn("rank", F.dense_rank().over(order).cast("long"))


def permuted(df: DataFrame, key: Sequence[str], columns: Sequence[str], seed: int) -> DataFrame:
    """Each row with the ``perm_<c>`` values of a drawn partner row: two numberings of the
    table, by key and by draw, joined on the number."""
    original = number_rows(df, [F.asc(k) for k in key], "_no")
    by_draw = [draw_order(seed, *[F.col(k) for k in key]), *[F.asc(k) for k in key]]
    drawn = number_rows(df.select(*key, *columns), by_draw, "_no")
    partner = drawn.select("_no", *[F.col(c).alias(f"perm_{c}") for c in columns])
    return original.join(partner, "_no").drop("_no")


def permutation_importance(df: DataFrame, model: LogisticRegressionModel, columns: Sequence[str], label: str,
                           key: Sequence[str], seed: int = 0) -> DataFrame:
    """Loss and accuracy with one feature shuffled at a time; ``error`` is baseline - shuffled
    loss, the most important feature first."""
    rows = materialise(permuted(df, key, columns, seed), "permuted")
    spark, results = df.sparkSession, []
    for name in [None, *columns]:
        swapped = rows.select(label, *[F.col(f"perm_{c}" if c == name else c).alias(c) for c in columns])
        scored = model.transform(VectorAssembler(inputCols=list(columns), outputCol=model.getFeaturesCol()).transform(swapped))
        scored = scored.withColumn("_p", positive_probability())
        row = scored.agg(binary_cross_entropy(label, "_p").alias("loss"), accuracy(label, "prediction").alias("accuracy")).first()
        results.append((name, row["loss"], row["accuracy"]))
    baseline = results[0][1]
    table = spark.createDataFrame([(n, l, a, baseline - l) for n, l, a in results[1:]], "feature string, loss double, accuracy double, error double")
    return table.orderBy("error")
