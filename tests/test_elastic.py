"""The sparse item-item model against written results, brute force and its optimality conditions."""

import numpy as np
import pytest

from trolley.operators import elastic, recommend as R


def triples(spark, x):
    rows = [(u, i, float(x[u][i])) for u in range(len(x)) for i in range(len(x[0])) if x[u][i]]
    return spark.createDataFrame(rows, "user int, item int, value double")


def weights_of(fitted):
    return {(r["item_from"], r["item_to"]): r["weight"] for r in fitted.collect()}


def brute_force(x, alpha=1.0, l1=0.1, positive=True):
    """Plain coordinate descent over all items, no screening and no working sets."""
    x = np.asarray(x, float)
    n, m = x.shape
    g, w = x.T @ x, np.zeros((x.shape[1],) * 2)
    for j in range(m):
        for _ in range(5000):
            for k in range(m):
                if k == j or g[k, k] == 0:
                    continue
                rho = (g[k, j] - g[k] @ w[:, j] + g[k, k] * w[k, j]) / n
                new = max(rho - alpha * l1, 0) if positive else np.sign(rho) * max(abs(rho) - alpha * l1, 0)
                w[k, j] = new / (g[k, k] / n + alpha * (1 - l1))
    return w


def test_two_items(spark):
    urm = triples(spark, [[1, 1], [1, 0]])
    got = weights_of(elastic.slim_fit(urm)[0])
    assert got == pytest.approx({(0, 1): 0.210526, (1, 0): 0.285714}, abs=1e-6)
    assert elastic.slim_fit(urm, compat_topk=True)[0].count() == 0


def test_three_items_and_scores(spark):
    urm = triples(spark, [[2, 1, 0], [1, 1, 1], [0, 2, 1], [3, 0, 1]])
    fitted, status = elastic.slim_fit(urm)
    want = {(1, 0): 0.116998, (2, 0): 0.492274, (0, 1): 0.067492, (2, 1): 0.353035, (0, 2): 0.167292, (1, 2): 0.218555}
    assert weights_of(fitted) == pytest.approx(want, abs=1e-6)
    scores = {(r["user"], r["item"]): r["score"] for r in R.score_item_based(urm, fitted).collect()}
    assert [scores[0, i] for i in range(3)] == pytest.approx([0.116998, 0.134984, 0.553138], abs=1e-6)
    assert all(r["converged"] for r in status.collect()) and status.count() == 3
    assert weights_of(elastic.slim_fit(urm, topk=1)[0]).keys() == {(2, 0), (2, 1), (1, 2)}


@pytest.mark.parametrize("positive", [True, False])
def test_working_sets_give_the_full_solution(spark, positive):
    """Negative entries make correlations alone a wrong screen; the optimality check repairs it."""
    draw = np.random.default_rng(3)
    x = np.where(draw.random((40, 9)) < 0.5, np.round(draw.normal(0.5, 1.5, (40, 9)), 2), 0)
    got = weights_of(elastic.slim_fit(triples(spark, x), alpha=0.5, positive=positive, width=2)[0])
    want = brute_force(x, alpha=0.5, positive=positive)
    dense = np.zeros_like(want)
    for (i, j), w in got.items():
        dense[i, j] = w
    np.testing.assert_allclose(dense, want, atol=1e-7)


def test_tiled_gram_with_a_huge_profile(spark):
    """One user holds every item; many small tiles give the same matrix as one product."""
    draw = np.random.default_rng(5)
    x = np.where(draw.random((30, 20)) < 0.1, 1.0, 0.0)
    x[0] = np.arange(1, 21)
    got = np.zeros((20, 20))
    for r in elastic.gram(triples(spark, x), users_per_block=4, items_per_block=3).collect():
        got[r["i"], r["j"]] += r["g"]
    np.testing.assert_allclose(got, x.T @ x)


def test_optimality(spark):
    draw = np.random.default_rng(9)
    urm = triples(spark, np.where(draw.random((60, 12)) < 0.4, draw.integers(1, 5, (60, 12)), 0))
    fitted, _ = elastic.slim_fit(urm, width=4)
    assert max(r["violation"] for r in elastic.kkt_residuals(urm, fitted).collect()) < 1e-7


@pytest.mark.parametrize("pairs", [0, 10**9])
def test_gram_tiles_dense_and_sparse(spark, monkeypatch, pairs):
    draw = np.random.default_rng(3)
    x = np.where(draw.random((40, 30)) < 0.2, draw.integers(1, 5, (40, 30)), 0)
    x[0] = 1  # one profile over all blocks
    monkeypatch.setattr(elastic, "SPARSE_PAIRS", pairs)
    got = {(r["i"], r["j"]): r["g"] for r in elastic.gram(triples(spark, x), users_per_block=7, items_per_block=6).collect()}
    want = x.T @ x
    assert got == {(i, j): float(want[i, j]) for i in range(30) for j in range(30) if want[i, j]}


@pytest.mark.parametrize("pairs", [0, 10**9])
@pytest.mark.parametrize("users_per_block", [7, 2048])
def test_gram_of_the_strongest_partners(spark, monkeypatch, pairs, users_per_block):
    """The largest entries of a column, equal ones by the smaller item, in few rows; a user or an item that is missing adds nothing."""
    draw = np.random.default_rng(4)
    x = np.where(draw.random((20, 30)) < 0.4, draw.integers(-1, 3, (20, 30)), 0)
    monkeypatch.setattr(elastic, "SPARSE_PAIRS", pairs)
    monkeypatch.setattr(elastic, "STRIP", 40)
    odd = spark.createDataFrame([(None, 1, 1.0), (1, None, 1.0), (2, None, 1.0)], "user int, item int, value double")
    urm = triples(spark, x).selectExpr("CAST(user AS INT) AS user", "CAST(item AS INT) AS item", "CAST(value AS DOUBLE) AS value").unionByName(odd)
    rows = elastic.gram(urm, users_per_block=users_per_block, items_per_block=6, strongest=3).collect()
    g = x.T @ x
    for j in range(30):
        got = sorted(((-r["g"], r["i"]) for r in rows if r["j"] == j and r["i"] != j))[:3]
        assert got == sorted((-float(g[i, j]), i) for i in range(30) if i != j and g[i, j])[:3]
    assert {r["i"]: r["g"] for r in rows if r["i"] == r["j"]} == {i: float(g[i, i]) for i in range(30) if g[i, i]}
    assert len(rows) <= 30 + 30 * 3 * 10
