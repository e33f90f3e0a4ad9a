import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers  # noqa: F401
from trolley.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int, node long, point string"


def brute(ids, x, top=20, every=20):
    out = {}
    for i, q in enumerate(ids):
        if q % every == 0:
            score = (x * x[i]).sum(1)
            order = [j for j in np.lexsort((ids, -score)) if j != i][:top]
            out[q] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def table_of(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v], 1, 7, "x") for i, v in zip(ids, x)], SCHEMA)


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / max(len(w), 1) for q, w in want.items()])


def test_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got, want = found(N.op6_neighbours(spark, "/root/testdata/sf0.1")), brute(ids, x)
    assert set(got) == set(want) and recall(got, want) > 0.95
    place = {i: k for k, i in enumerate(ids)}
    for q, answers in got.items():
        assert all(s == pytest.approx(float(x[place[q]] @ x[place[i]]), abs=1e-12) for i, s in answers)
        assert [(-s, i) for i, s in answers] == sorted((-s, i) for i, s in answers)


def test_norms_and_copies(spark):
    """Different norms, and a vector that a third of the rows repeat."""
    draw = np.random.default_rng(2)
    x = draw.normal(0, 1, (300, 8)) * draw.uniform(0.2, 3, (300, 1))
    x[::3] = x[0]
    x, ids = x.astype(np.float32).astype(float), np.arange(300)
    got, want = found(N.nearest_neighbours(table_of(spark, ids, x))), brute(ids, x)
    assert set(got) == set(want) and recall(got, want) > 0.95
    assert all(len(a) == 20 for a in got.values())
    assert [i for i, _ in got[60]][:3] == [i for i, _ in want[60]][:3]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (20, [0.0, 1.0]), (40, None), (60, [0.0, 0.0]), (80, [1.0, nan]), (100, [inf, 1.0]),
            (120, [None, 1.0]), (140, []), (160, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (2, [0.5, 0.5])]
    docs = spark.createDataFrame([(i, v, 1, 1, "x") for i, v in rows], SCHEMA)
    got = found(N.nearest_neighbours(docs))
    assert got == {0: [(1, 1.0), (2, 0.5), (20, 0.0)], 20: [(2, 0.5), (0, 0.0), (1, 0.0)]}
    assert N.nearest_neighbours(spark.createDataFrame([], SCHEMA)).count() == 0
    assert N.nearest_neighbours(docs.filter("vec_id = 0")).count() == 0


def test_small_cells_and_blocks(spark, monkeypatch):
    for name, value in (("CELL", 20), ("BLOCK", 30), ("PIVOTS", 10)):
        monkeypatch.setattr(N, name, value)
    draw = np.random.default_rng(5)
    centres = draw.normal(0, 1, (6, 12))
    x = (centres[draw.integers(0, 6, 900)] + draw.normal(0, 0.6, (900, 12))).astype(np.float32).astype(float)
    got = found(N.nearest_neighbours(table_of(spark, np.arange(900), x).withColumn("vec_id", F.col("vec_id"))))
    assert recall(got, brute(np.arange(900), x)) > 0.9
