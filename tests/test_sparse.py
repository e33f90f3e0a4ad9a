"""Sparse rows and the linear models on them, against plain numpy."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trolley.operators import feature_config as C, models as M, sparse as S
from trolley.operators.metrics import binary_cross_entropy
from trolley.plans.scoring import family_blend


def table(spark, x, labels):
    rows = [(i, [int(j) for j in np.flatnonzero(r)], [float(v) for v in r[np.flatnonzero(r)]], *map(float, y)) for i, (r, y) in enumerate(zip(x, labels.T))]
    names = ", ".join(f"y{t} double" for t in range(len(labels)))
    return spark.createDataFrame(rows, f"id long, indices array<int>, values array<double>, {names}").repartition(5)


@pytest.fixture(scope="module")
def data():
    draw = np.random.default_rng(8)
    x = np.where(draw.random((300, 40)) < 0.2, draw.normal(0, 2, (300, 40)), 0)
    x[:3] = 0
    return x, draw


def test_ridge_equals_the_closed_form(spark, data):
    x, draw = data
    y = np.stack([x @ draw.normal(0, 1, 40) + 7 + draw.normal(0, 1, 300), draw.normal(3, 2, 300)])
    found = S.ridge(table(spark, x, y), ["y0", "y1"], 40, alpha=0.7)
    centred = x - x.mean(0)
    want = np.linalg.solve(centred.T @ centred + 0.7 * np.eye(40), centred.T @ (y - y.mean(1, keepdims=True)).T)
    assert np.allclose(found.weights, want, atol=1e-8)
    assert np.allclose(found.intercepts, y.mean(1) - x.mean(0) @ want, atol=1e-8)
    scored = {r["id"]: (r["a"], r["b"]) for r in found.predict(table(spark, x, y), ["a", "b"]).collect()}
    assert np.allclose([scored[i] for i in range(300)], x @ found.weights + found.intercepts)


def test_all_targets_in_as_many_scans_as_the_slowest(spark, data):
    x, draw = data
    z = x @ draw.normal(0, 1, (40, 3))
    y = np.vstack([(z.T + draw.logistic(0, 1, (3, 300)) > 0).astype(float), np.zeros((1, 300))])
    rows = table(spark, x, y)
    found = S.logistic(rows, ["y0", "y1", "y2", "y3"], 40, c=0.5)
    p = 1 / (1 + np.exp(-(x @ found.weights + found.intercepts)))
    assert np.abs(x.T @ (p - y.T) + found.weights / 0.5).max() < 300 * 1e-6
    assert np.abs((p - y.T).sum(0)).max() < 300 * 1e-6
    single = [S.logistic(rows, [f"y{t}"], 40, c=0.5) for t in range(3)]
    assert found.scans <= max(s.scans for s in single)
    assert np.allclose(found.weights[:, :3], np.hstack([s.weights for s in single]), atol=1e-4)


def test_wide_gradients_travel_in_blocks(spark, monkeypatch):
    """A vocabulary of 100,000 terms, more than one block of the gradient, and no matrix of that width."""
    base = spark.range(2000).withColumn("y", (F.col("id") % 7).cast("double"))
    weights = base.select("id", F.explode(F.array(*[F.format_string("t%06d", (F.col("id") * 50 + k) % 100_000) for k in range(50)])).alias("term"), F.lit(1.0).alias("weight"))
    rows, size = S.assemble_sparse(base, ["id"], [S.block(weights)], ["y"])
    assert size == 100_001
    first = rows.filter("id = 3").first()
    assert list(first["indices"]) == [*range(150, 200), 100_000] and first["values"][-1] == 3.0
    model = S.ridge(rows.select("indices", "values", "y"), ["y"], size, alpha=1.0)
    assert model.weights.shape == (100_001, 1)
    off = model.predict(rows, ["p"]).agg(F.max(F.abs(F.col("p") - F.col("y")))).first()[0]
    assert off < 0.05  # the label is one of the features


def test_vectors_and_missing_entries(spark):
    base = spark.createDataFrame([(1, 2.0), (2, None), (3, 0.0)], "id long, n double")
    weights = spark.createDataFrame([(1, "b", 0.5), (1, "a", 1.5), (3, "zz", 1.0), (9, "a", 1.0)], "id long, term string, weight double")
    vocabulary = spark.createDataFrame([("a",), ("b",)], "term string")
    rows, size = S.assemble_sparse(base, ["id"], [S.block(weights, vocabulary)], ["n"])
    found = {r["id"]: r["features"] for r in S.as_vectors(rows, size).collect()}
    assert {k: (v.size, list(v.indices), list(v.values)) for k, v in found.items()} == {1: (3, [0, 1, 2], [1.5, 0.5, 2.0]), 2: (3, [], []), 3: (3, [], [])}


def test_columns_split_by_type(spark):
    df = spark.createDataFrame([(1, "x", True, 2, 0.5), (2, None, False, None, 1.5)], "id long, s string, b boolean, n int, f double")
    assert S.column_kinds(df, ["id"]) == (["s", "b"], ["n", "f"])
    found = {r["id"]: list(r["v"]) for r in M.assemble([df], ["id"]).select("id", vector_to_array("features").alias("v")).collect()}
    assert found == {1: [0, 1, 1, 2, 0.5], 2: [1, 0, 0, 0, 1.5]}  # b=false, b=true, s=x, n, f


def test_families(spark, data):
    columns = ["R_L_a b", "tfidf_item_a", "tfidf_item_zz", "tfidf_b", "CF1"]
    families = M.column_families(columns, ["a b", "c"])
    assert families == {"windows": ["R_L_a b", "CF1"], "terms": ["tfidf_item_a", "tfidf_item_zz", "tfidf_b"],
                        "target_terms": ["R_L_a b", "tfidf_item_a", "tfidf_b", "CF1"], "all": columns}
    x, draw = data
    named = spark.createDataFrame([(i, *map(float, r[:5]), int(r[0] > 0), int(draw.random() < 0.3)) for i, r in enumerate(x)],
                                  "customer_id long, `R_L_a b` double, tfidf_item_a double, tfidf_item_zz double, tfidf_b double, CF1 double, u int, v int")
    fitted = M.family_models(named, named.drop("u", "v"), families, ["u", "v"], ["customer_id"])
    blended = {r["customer_id"]: r for r in family_blend(list(fitted.values()), ["u", "v"]).collect()}
    parts = [{r["customer_id"]: r for r in f.collect()} for f in fitted.values()]
    assert len(parts) == 4
    for i in (0, 7, 299):
        assert blended[i]["u"] == pytest.approx(sum(p[i]["u"] for p in parts) / 4)
    loss = fitted["all"].join(named.select("customer_id", F.col("u").alias("y")), "customer_id").agg(binary_cross_entropy("y", "u")).first()[0]
    assert loss < 0.4


def test_families_scale_and_store_the_columns_once(spark, data, monkeypatch):
    """Families of the same columns share a fit, and each family equals its own fit on its columns alone."""
    x, draw = data
    rows = spark.createDataFrame([(i, *map(float, r[:4]), int(r[0] + draw.normal() > 0)) for i, r in enumerate(x)], "customer_id long, a double, b double, c double, d double, u int")
    scaled, fits, minmax, fit = [], [], M.minmax, M.logistic_fit
    monkeypatch.setattr(M, "minmax", lambda *args: scaled.append(args) or minmax(*args))
    monkeypatch.setattr(M, "logistic_fit", lambda *args: fits.append(args) or fit(*args))
    found = M.family_models(rows, rows, {"one": ["c", "a"], "two": ["b", "d"], "same": ["c", "a"]}, ["u"], ["customer_id"])
    assert len(scaled) == 2 and len(fits) == 2
    for name, columns in (("one", ["c", "a"]), ("two", ["b", "d"]), ("same", ["c", "a"])):
        alone = VectorAssembler(inputCols=columns, outputCol="features").transform(minmax(rows, columns))
        want = {r["customer_id"]: r["u"] for r in M.fit_targets(alone, ["u"], 1.0, 1e-5, 100).predict(S.from_vectors(alone.select("customer_id", "features")), ["u"], logistic=True).collect()}
        assert {r["customer_id"]: r["u"] for r in found[name].collect()} == pytest.approx(want, abs=1e-12)


def test_per_target_fits_agree_with_the_estimator(spark, data):
    x, draw = data
    rows = spark.createDataFrame([(i, *map(float, r[:4]), int(r[0] + r[1] + draw.normal() > 0)) for i, r in enumerate(x)], "id long, a double, b double, c double, d double, y int")
    ready = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(rows).select("id", "features", "y")
    ours = {r["id"]: r["y"] for r in M.fit_per_target(ready, ready, ["y"], ["id"]).collect()}
    theirs = M.logistic(1.0, 300, "y").setTol(1e-12).fit(ready).transform(ready).select("id", vector_to_array("probability")[1].alias("p")).collect()
    assert max(abs(ours[r["id"]] - r["p"]) for r in theirs) < 1e-4


def assembled(spark, data):
    """300 rows, five labels of other rates, and a last feature that is always 0."""
    x, _ = data
    rows = [(i, float(r[0]), 0.0 if i % 3 else float(r[1]), 0.0, *[int(r[0] + r[2] > t / 3) for t in range(5)]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, " + ", ".join(f"y{t} int" for t in range(5)))
    return rows, VectorAssembler(inputCols=list("abc"), outputCol="features").transform(df).drop(*"abc")


def test_scans_meet_no_zeros(spark, data, monkeypatch):
    rows, ready = assembled(spark, data)
    met, fit = [], M.logistic_fit
    monkeypatch.setattr(M, "logistic_fit", lambda entries, *more: met.append(entries) or fit(entries, *more))
    model = M.fit_targets(ready, ["y0", "y1"])
    assert met[0].agg(F.sum(F.size("values"))).first()[0] == sum(v != 0 for r in rows for v in r[1:4])
    assert model.weights.shape == (3, 2) and (model.weights[2] == 0).all() and (model.weights[:2] != 0).all()
    dense = S.from_vectors(ready)
    for got, want in zip(*(sorted(map(tuple, model.predict(d.select("id", "indices", "values"), ["p", "q"], logistic=True).collect())) for d in (S.without_zeros(dense), dense))):
        assert got == pytest.approx(want, abs=1e-12)


def test_mean_probability_is_the_base_rate(spark, data):
    rows, ready = assembled(spark, data)
    names = [f"y{t}" for t in range(5)]
    model = M.fit_targets(ready, names)
    x, y = np.array([r[1:4] for r in rows]), np.array([r[4:] for r in rows])
    p = 1 / (1 + np.exp(-(x @ model.weights + model.intercepts)))
    assert np.abs(p.mean(0) - y.mean(0)).max() < 2e-9


def test_stored_configuration(spark, tmp_path):
    train = spark.createDataFrame([(1, "a b a", "q", 1.0, 5), (2, None, "", 3.0, 5)], "id long, t string, u string, x double, k int")
    new = spark.createDataFrame([(7, "b zz a a", None, 5.0, 6), (8, None, "q q", None, 5)], "id long, t string, u string, x double, k int")
    fitted = C.fit_config(train, ["t", "u"], ["x", "k"])
    fitted.save(spark, str(tmp_path / "c"))
    loaded = C.load_config(spark, str(tmp_path / "c"))
    assert (loaded.lengths, loaded.ranges, loaded.columns) == (fitted.lengths, fitted.ranges, ["t", "u", "x", "k"])
    rows = {r["id"]: tuple(r)[1:] for r in loaded.apply(new, ["id"]).collect()}
    assert rows == {7: ([2, 1, 1], [0], 2.0, 1.0), 8: ([0, 0, 0], [1], None, 0.0)}
    spark.createDataFrame([('{"version": 99}',)], "config string").write.mode("overwrite").parquet(str(tmp_path / "c" / "config"))
    with pytest.raises(ValueError, match="version 99"):
        C.load_config(spark, str(tmp_path / "c"))


def test_few_features_take_few_scans(spark):
    """Correlated features of unlike size reach a mean gradient of 1e-9 in a few scans, at the optimum."""
    draw = np.random.default_rng(8)
    x = draw.normal(0, 1, (400, 6)) @ draw.normal(0, 1, (6, 6)) * [1, 10, 0.1, 1, 5, 1]
    y = np.column_stack([x @ draw.normal(0, 0.3, 6) + draw.logistic(0, 1, 400) > 0, np.ones(400)]).astype(float)
    rows = spark.createDataFrame([(list(range(6)), list(map(float, r)), float(a), float(b)) for r, (a, b) in zip(x, y)], "indices array<int>, values array<double>, a double, b double")
    found = S.logistic(rows, ["a", "b"], 6, tolerance=1e-9)
    assert found.scans <= 20
    p = 1 / (1 + np.exp(-(x @ found.weights + found.intercepts)))
    assert np.abs(x.T @ (p - y) + found.weights).max() <= 1e-9 * 400 and np.abs((p - y).sum(0)).max() <= 1e-9 * 400
