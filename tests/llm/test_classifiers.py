import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LONG, awkward, documents, empty
from trolley.llm import language as L, toxicity as T

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def toxic(spark):
    docs = documents(spark, SF)
    return T.learned(spark, SF, docs)


def test_toxicity_held_out(spark):
    rows = T.op7_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("held_out").collect()
    score, y = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows])
    rank = np.argsort(np.argsort(score))
    positives = y.sum()
    assert (rank[y == 1].sum() - positives * (positives - 1) / 2) / positives / (len(y) - positives) > 0.9
    assert np.mean(score[y == 0] >= 0.7) < 0.01 and np.mean(score[y == 1] >= 0.7) > 0.6
    assert all(r["predicted"] == (r["score"] >= 0.7) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def test_toxicity_awkward_rows(spark, toxic):
    docs = awkward(spark)
    rows = T.score(docs, toxic).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert by_id[3] == by_id[4] == by_id[9] and by_id[1] == by_id[2] and by_id[6] == by_id[7]
    assert T.score(empty(spark), toxic).count() == 0


def test_toxicity_without_labels(spark):
    docs, none = awkward(spark), spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in T.score(docs, T.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    assert all(r["score"] < 0.5 for r in T.score(docs, T.fit(docs, one)).collect())
    assert T.score(empty(spark), T.fit(empty(spark), one)).count() == 0


def test_presence_not_counts(toxic):
    def score(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return toxic.scores(data, np.array([0, len(data)]))[0]

    assert abs(score("the stupid clown " * 2) - score("the stupid clown " * 500)) < 1e-9


def test_language_held_out(spark):
    rows = L.op4_language(spark, SF).join(documents(spark, SF).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_language_mixtures(spark):
    docs = documents(spark, SF)
    model = L.learned(docs)
    by = {r["lang"]: r["text"] for r in docs.filter("n_chars between 1500 and 3000").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    texts = [by["en"], by["en"][:1200] + " " + by["de"][:400], by["fr"][:600] + " " + by["es"][:1500]]
    mixed = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: dict(zip(model.languages, r["proportions"])) for r in L.predict(mixed, model).collect()}
    assert found[0]["en"] > 0.9 and 0.15 < found[1]["de"] < 0.35 and found[1]["en"] > 0.6 and 0.2 < found[2]["fr"] < 0.4
    assert found[2]["de"] < 0.05


def test_language_awkward_rows(spark):
    docs = awkward(spark)
    model = L.learned(documents(spark, SF))
    rows = L.predict(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] in (3, 4, 5, 8, 9):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (6, 7)} == {"en"} and LONG
    assert L.predict(empty(spark), model).count() == 0
    nothing = L.fit(empty(spark))
    assert {r["lang_pred"] for r in L.predict(docs, nothing).collect()} == {"und"}
    single = L.fit(docs.filter("doc_id in (1, 2)"))
    assert {r["lang_pred"] for r in L.predict(docs.filter("doc_id in (1, 6)"), single).collect()} == {"en"}


def test_features_of_a_slice_take_bounded_memory():
    text = np.frombuffer(np.random.default_rng(5).choice(np.frombuffer(b"etaoin shrdlu", np.uint8), 1 << 20).tobytes(), np.uint8)
    ends = np.linspace(0, len(text), 501).astype(int)
    tracemalloc.start()
    where, docs = T.present(text, ends, np.ones(T._SIZE, bool))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 * len(text), most / len(text)  # bytes for a byte of text; more if all orders are held at once
    pairs = np.unique(docs.astype(np.int64) << 32 | where)
    assert len(pairs) == len(where) and docs.max() == 499 and where.max() < T._SIZE
