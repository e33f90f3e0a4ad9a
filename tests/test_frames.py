"""Frames fitted on one table and replayed on another, on a small table worked out by hand."""

import pytest
from pyspark.sql import functions as F

from trolley.operators.rfm import PENALTY
from trolley.plans import frames as P

TARGETS = ["aa one", "bb two"]


@pytest.fixture(scope="module")
def raw(spark):
    days = {"c1": ["2020-01-01", "2020-02-01", "2020-03-20"], "c2": ["2020-02-10", "2020-03-25"], "c3": ["2020-03-25"]}
    rows = [(c, item, f"{c}{d}{item}", d, 2.0, 10.0 + n) for c, dates in days.items() for d in dates for n, item in enumerate(TARGETS if c != "c3" else ["cc"])]
    df = spark.createDataFrame(rows, "customer_id string, item_id string, transaction_id string, InvoiceDate string, item_qty double, item_amt double")
    return df.withColumn("InvoiceDate", F.col("InvoiceDate").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def template(spark):
    return spark.createDataFrame([("c1",), ("c3",), ("new",), ("new",)], "customer_id string")


FITS = {"rolling": lambda raw: P.fit_rolling(raw, TARGETS, n=2), "gaps": lambda raw: P.fit_gaps(raw, TARGETS, n=2, popular=3),
        "last_visit": lambda raw: P.fit_last_visit(raw, TARGETS, n=2)}


@pytest.mark.parametrize("kind", list(FITS))
def test_scored_columns_are_the_training_ones(spark, raw, template, tmp_path, kind):
    rows, frame = FITS[kind](raw)
    frame.save(spark, str(tmp_path / "f"))
    assert P.load_frame(spark, str(tmp_path / "f")) == frame
    scored = P.score(frame, raw, template)
    assert scored.columns == ["customer_id", *[c for c in rows.columns if c not in ("origin", "customer_id") and not c.startswith("Target_")]]
    found = {r["customer_id"]: r.asDict() for r in scored.collect()}
    assert sorted(found) == ["c1", "c3", "new"]
    terms = [c for c in scored.columns if c.startswith("tfidf_")]
    assert terms and abs(sum(found["c1"][c] ** 2 for c in terms) - 1) < 1e-9
    for name in scored.columns[1:]:
        assert found["new"][name] == (0.0 if name in terms else PENALTY)


def test_dates_of_the_scored_rows(raw, template):
    rolling = P.score(FITS["rolling"](raw)[1], raw, template).filter("customer_id = 'c1'").first()
    assert (rolling["R_L_aa one"], rolling["R_F_aa one"], rolling["F30_aa one"], rolling["M360sum_bb two"]) == (5, 84, 1, 33.0)
    visits = P.score(FITS["last_visit"](raw)[1], raw, template).filter("customer_id = 'c1'").first()
    assert (visits["R_F_aa one"], visits["T_F"], visits["F1_aa one"], visits["M360_bb two"]) == (79, 79, 1, 11.0)
    gaps = P.score(FITS["gaps"](raw)[1], raw, template).filter("customer_id = 'c1'").first()
    assert gaps["DayDiffMean_aa one"] == 39.5


def test_replay_on_other_rows(spark, raw, template):
    """A vocabulary or item the new rows lack stays a column; an item only they hold makes none."""
    _, frame = FITS["gaps"](raw)
    new = raw.filter("customer_id = 'c1' AND item_id = 'aa one'").unionByName(raw.filter("customer_id = 'c3'").withColumn("item_id", F.lit("zz nine")))
    scored = P.score(frame, new, template)
    assert scored.columns[1:] == list(frame.columns)
    row = scored.filter("customer_id = 'c1'").first()
    assert row["DayDiffMean_bb two"] == PENALTY and row["tfidf_two"] == 0.0 and row["tfidf_aa"] > 0


def test_empty_template(spark, raw, template):
    assert P.score(FITS["rolling"](raw)[1], raw, template.filter("customer_id = 'none'")).count() == 0
