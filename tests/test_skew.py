"""One customer owns a third of the rows; results equal a brute-force pandas computation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trolley.operators import gaps, sequences, summary
from trolley.operators.filters import group_size
from trolley.operators.ordering import dense_rank_in_key, position_in_key, prior_times
from trolley.plans import universe as U

HOT = 50  # rows beyond which a key counts as hot here


@pytest.fixture(scope="module")
def frame():
    draw = np.random.default_rng(7)
    n = 1500
    customer = np.where(np.arange(n) % 3 == 0, 1, draw.integers(2, 60, n))
    minutes = draw.integers(0, 60 * 24 * 90, n)
    minutes[::11] = minutes[0]  # many purchases at one time
    return pd.DataFrame({
        "customer_id": customer, "item_id": [f"i{k}" for k in draw.integers(0, 4, n)], "transaction_id": np.arange(n),
        "InvoiceDate": pd.Timestamp("2024-01-01") + pd.to_timedelta(minutes, unit="m"),
        "item_qty": draw.integers(1, 5, n).astype(float), "item_amt": draw.integers(1, 500, n) / 4})


@pytest.fixture(scope="module")
def df(spark, frame):
    made = spark.createDataFrame(frame)
    return made.withColumn("InvoiceDate", made["InvoiceDate"].cast("timestamp_ntz")).repartition(5)


@pytest.mark.parametrize("hot_rows", [HOT, 10**6])
@pytest.mark.parametrize("keys", [["customer_id"], ["customer_id", "item_id"]])
@pytest.mark.parametrize("fill_before", [False, True])
def test_gap_stats(df, frame, keys, hot_rows, fill_before):
    f = frame.sort_values("InvoiceDate", kind="stable").copy()
    for lag, name in ((1, "DayDiff"), (2, "DayDiff2"), (3, "DayDiff3")):
        f[name] = (f["InvoiceDate"] - f.groupby(keys)["InvoiceDate"].shift(lag)).dt.days
        if fill_before:
            f[name] = f[name].fillna(999)
    want = f.groupby(keys)[["DayDiff", "DayDiff2", "DayDiff3"]].agg(["mean", "std"])
    want.columns = [a + b.capitalize() for a, b in want.columns]
    got = gaps.gap_stats(df, keys, fill_before=fill_before, hot_rows=hot_rows).toPandas().set_index(keys).sort_index()
    pd.testing.assert_frame_equal(got[list(want.columns)].astype(float), want.sort_index(), check_index_type=False, rtol=1e-9)


@pytest.mark.parametrize("hot_rows", [HOT, 10**6])
def test_lags(df, frame, hot_rows):
    f = frame.sort_values("InvoiceDate", kind="stable").copy()
    for lag in (1, 2, 3):
        f[f"lag{lag}"] = f.groupby("customer_id")["InvoiceDate"].shift(lag)
    columns = ["customer_id", "InvoiceDate", "lag1", "lag2", "lag3"]
    rows = lambda x: sorted(map(str, x[columns].itertuples(index=False, name=None)))
    assert rows(gaps.lags(df, ["customer_id"], hot_rows=hot_rows).toPandas()) == rows(f)


@pytest.mark.parametrize("hot_rows", [HOT, 10**6])
def test_visit_rank(df, frame, hot_rows):
    want = frame.set_index("transaction_id").groupby("customer_id")["InvoiceDate"].rank(method="dense", ascending=False).astype(int)
    got = summary.visit_rank(df, hot_rows=hot_rows).toPandas().set_index("transaction_id")["rank"]
    assert got.sort_index().tolist() == want.sort_index().tolist()


@pytest.mark.parametrize("hot_rows", [HOT, 10**6])
def test_sequences_are_whole(df, frame, hot_rows):
    steps = sequences.sequence_steps(df, frame["InvoiceDate"].max().to_pydatetime(), hot_rows=hot_rows)
    parts = sequences.sequence(steps, steps_per_row=40).toPandas().sort_values(["customer_id", "part"])
    joined = parts.groupby("customer_id")["categorical_sequence_items"].agg(", ".join)
    order = frame.sort_values(["InvoiceDate", "item_id", "item_qty", "item_amt"], ascending=[False, True, True, True])
    want = order.groupby("customer_id")["item_id"].agg(", ".join)
    assert joined.to_dict() == want.to_dict()
    assert parts["steps"].max() <= 40
    newest = sequences.first_steps(steps, 60).groupBy("customer_id").count().toPandas()
    assert newest.set_index("customer_id")["count"].to_dict() == frame.groupby("customer_id").size().clip(upper=60).to_dict()


def test_rank_within_hot_key(df, frame):
    want = frame.set_index("transaction_id").groupby("customer_id")["item_amt"].rank(method="dense", ascending=False).astype(int)
    got = dense_rank_in_key(df, ["customer_id"], "item_amt").toPandas().set_index("transaction_id")["rank"]
    assert got.sort_index().tolist() == want.sort_index().tolist()


def test_newest_visits(df, frame):
    want = frame.groupby("customer_id")["InvoiceDate"].agg(lambda s: sorted(set(s), reverse=True)[:3]).to_dict()
    got = {r["customer_id"]: [pd.Timestamp(v) for v in r["visits"]] for r in U.newest_visits(df, 3).collect()}
    assert got == want


def test_stacked_universe_is_union_of_single_ones(df):
    """Six rolling universes built at once equal each one built from its own cut of the data."""
    items = ["i0", "i1"]
    stacked = U.universe_rolling(df, items, n=3, step=20).rows
    for origin, rd, end in U.origins(df, 3, 20):
        cut = df.filter(F.col("InvoiceDate") <= F.lit(str(end)).cast("timestamp_ntz"))
        single = U.universe_rolling(cut, items, n=1, step=20).rows.drop("origin")
        part = stacked.filter(F.col("origin") == origin).select(*single.columns)
        assert sorted(map(str, part.collect())) == sorted(map(str, single.collect()))


def test_missing_keys_times_and_bursts(spark):
    """NULL keys, NULL times and hundreds of rows of one time: the hot path changes nothing."""
    rows = [(None if i % 4 == 0 else 1 if i % 4 < 3 else i, f"i{i % 7}", None if i % 9 == 0 else 60 * (0 if i % 2 else i)) for i in range(2000)]
    df = (spark.createDataFrame(rows, "customer_id long, item_id string, m long")
          .select("customer_id", "item_id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m")).cast("timestamp_ntz").alias("InvoiceDate")))

    def same(make):
        cold, hot = ([tuple(r) for r in make(n).collect()] for n in (10**6, HOT))
        assert sorted(cold, key=repr) == sorted(hot, key=repr)
        return cold

    ties = [F.asc("item_id")]
    placed = same(lambda n: position_in_key(df, ["customer_id"], "InvoiceDate", ties, hot_rows=n))
    assert len(placed) == len(rows)
    assert len(same(lambda n: summary.visit_rank(df, hot_rows=n).select("customer_id", "item_id", "InvoiceDate", "rank"))) == len(rows)
    same(lambda n: prior_times(df, ["customer_id"], "InvoiceDate", hot_rows=n))
    assert group_size(df).count() == len(rows)


def test_long_item_lists_make_whole_grids(spark):
    from trolley.operators.recommend import score_grid
    users = spark.createDataFrame([(1,), (2,)], "customer_id long")
    assert score_grid(users, [f"i{n}" for n in range(1500)]).distinct().count() == 3000
