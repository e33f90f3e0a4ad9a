"""Written-down results on small inputs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trolley.functions import columns as C
from trolley.functions import text as X
from trolley.functions.dates import floor_days
from trolley.operators import baskets as B
from trolley.operators import cleaning, gaps, metrics, rfm, sampling, summary
from trolley.operators import text as T
from trolley.operators.ordering import number_rows, running_sums
from trolley.sources.tables import read_baskets, read_table

BASKETS = ["Bread,Milk,,", "Bread,Diapers,Beer,Eggs", "Milk,Diapers,Beer,Cola", "Bread,Milk,Diapers,Beer", "Bread,Milk,Diapers,Cola",
           "Bread,Milk,,", "Bread,Cola,Beer,Milk", "Milk,Bread,Beer,Cola", "Bread,Milk,Diapers,Beer", "Bread,Beer,Diapers,Diapers"]
RD = datetime(2020, 1, 31, 8)


@pytest.fixture(scope="module")
def lines(tmp_path_factory):
    path = tmp_path_factory.mktemp("b") / "baskets.csv"
    path.write_bytes("\r\n".join(BASKETS).encode())
    return str(path)


def test_baskets_and_rules(spark, lines):
    baskets = read_baskets(spark, lines).withColumn("b", F.monotonically_increasing_id())
    found = B.frequent_itemsets(baskets, 0.2)
    assert {r["k"]: r["count"] for r in found.sets.groupBy("k").count().collect()} == {1: 6, 2: 12, 3: 9, 4: 2}
    single = {r["items"][0]: r["freq"] for r in found.sets.filter("k = 1").collect()}
    assert single == {"Bread": 9, "Milk": 8, "Beer": 7, "Diapers": 6, "Cola": 4, "": 2}
    rules = {tuple(r["lhs"]): r["confidence"] for r in B.rules_for(found, ["Milk"], 0.5).collect()}
    assert len(rules) == 14
    assert rules[("",)] == 1.0 and rules[("Cola",)] == 1.0
    assert rules[("Beer",)] == pytest.approx(5 / 7) and rules[("Beer", "Bread", "Diapers")] == 0.5
    assert B.rules_for(found, ["Caviar"], 0.5).count() == 0
    levels = B.frequent_itemsets_levelwise(baskets, 0.2, "b")
    as_set = lambda sets: {(tuple(r["items"]), r["freq"]) for r in sets.collect()}
    assert as_set(levels.sets) == as_set(found.sets)
    assert B.support(found, ["Milk", "Bread"]).first()["support"] == pytest.approx(0.7)


def test_two_item_right_hand_side(spark, lines):
    found = B.frequent_itemsets(read_baskets(spark, lines), 0.2)
    rules = {tuple(r["lhs"]): r["confidence"] for r in B.rules_for(found, ["Milk", "Bread"], 0.0).collect()}
    assert rules[("Cola",)] == pytest.approx(3 / 4)
    assert rules[("Beer", "Diapers")] == pytest.approx(2 / 5)


def test_support_bound_is_inclusive(spark):
    rows = [(["x", "y"],)] * 7 + [(["y"],)] * 93
    found = B.frequent_itemsets(spark.createDataFrame(rows, "items array<string>"), 0.07)
    assert {tuple(r["items"]) for r in found.sets.collect()} == {("x",), ("y",), ("x", "y")}
    assert B.smallest_count(0.07, 100) == 7


def test_dropping_empty_fields(spark, lines):
    items = read_baskets(spark, lines, keep_empty=False).collect()
    assert items[0]["items"] == ["Bread", "Milk"] and items[9]["items"] == ["Bread", "Beer", "Diapers"]


def test_rfm_and_recency(purchases):
    df = cleaning.drop_any_null(purchases)
    got = {(r["customer_id"], r["item_id"]): r for r in rfm.pair_rfm(df, (1, 7, 30), RD).collect()}
    row = got["C1", "A"]
    assert [row[c] for c in ("F1", "M1", "Q1", "F7", "M7", "Q7", "F30", "M30", "Q30")] == [1, 5, 1, 1, 5, 1, 3, 20, 4]
    assert [got["C2", "B"][c] for c in ("F1", "M30", "Q7")] == [1, 2, 1]
    days = {(r["customer_id"], r["item_id"]): (r["R_L"], r["R_F"]) for r in rfm.recency(df, RD).collect()}
    assert days == {("C1", "A"): (0, 29), ("C1", "B"): (0, 0), ("C2", "B"): (0, 0)}


def test_one_pass_equals_outer_chain(purchases):
    df = cleaning.drop_any_null(purchases)
    chain = rfm.rfm_join([rfm.pair_rfm(df, (w,), RD) for w in (1, 7, 30)])
    one = rfm.pair_rfm(df, (1, 7, 30), RD).select(*chain.columns)
    assert sorted(map(str, one.collect())) == sorted(map(str, chain.collect()))


def test_gap_statistics(purchases):
    df = cleaning.drop_any_null(purchases)
    after = {(r["customer_id"], r["item_id"]): r for r in gaps.gap_stats(df).collect()}
    a = after["C1", "A"]
    assert a["DayDiffMean"] == 14.5 and a["DayDiffStd"] == pytest.approx(7.778175, abs=1e-6)
    assert a["DayDiff2Mean"] == 29 and a["DayDiff2Std"] is None and after["C1", "B"]["DayDiffMean"] is None
    before = {(r["customer_id"], r["item_id"]): r for r in gaps.gap_stats(df, fill_before=True).collect()}
    a = before["C1", "A"]
    assert [a[c] for c in ("DayDiffMean", "DayDiffStd", "DayDiff2Mean", "DayDiff2Std")] == pytest.approx(
        [342.666667, 568.427949, 675.666667, 560.029761], abs=1e-6)
    assert before["C1", "B"]["DayDiffMean"] == 999 and before["C1", "B"]["DayDiffStd"] is None


def test_floor_days(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-01-01 13:00:00' a, TIMESTAMP_NTZ'2020-01-02 12:00:00' b, TIMESTAMP_NTZ'2019-12-31 11:00:00' c")
    row = df.select(floor_days(F.col("a"), F.col("b")), floor_days(F.col("a"), F.col("c"))).first()
    assert tuple(row) == (-1, 1)


def test_tfidf(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (2, "aa")], "id int, text string")
    counts = T.term_counts(docs, ["id"], "text")
    model = T.tfidf_fit(counts, 2)
    assert {r["term"]: round(r["idf"], 6) for r in model.vocabulary.collect()} == {"aa": 1.0, "bb": 1.405465}
    got = {(r["id"], r["term"]): round(r["weight"], 6) for r in T.tfidf_transform(model, counts, ["id"]).collect()}
    assert got == {(1, "aa"): 0.579739, (1, "bb"): 0.814802, (2, "aa"): 1.0}
    # Repeating every document five times changes the smoothing exactly as real copies do.
    five = T.term_counts(docs.crossJoin(spark.range(5).withColumnRenamed("id", "copy")), ["id", "copy"], "text")
    real = {r["term"]: r["idf"] for r in T.tfidf_fit(five, 10).vocabulary.collect()}
    assert {r["term"]: r["idf"] for r in T.tfidf_fit(counts, 2, copies=5).vocabulary.collect()} == pytest.approx(real)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, .9), (0, .5), (1, .5), (1, .7), (0, .1)], "label int, score double")
    assert metrics.auc(df).first()["auc"] == pytest.approx(0.916667, abs=1e-6)


def test_padding(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, ""), (3, "c zzz")], "id int, text string")
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "token string, id long")
    got = lambda n: {r["id"]: r["ids"] for r in T.to_padded_ids(docs, ["id"], "text", vocab, n).collect()}
    assert got(2) == {1: [2, 3], 2: [0, 0], 3: [3, 0]}
    assert got(5)[1] == [1, 2, 3, 0, 0]
    row = spark.sql("SELECT array(1,2,3) a").select(T.truncate_left(F.col("a"), 2), T.truncate_left(F.col("a"), 9)).first()
    assert [list(x) for x in row] == [[2, 3], [1, 2, 3]]


def test_sequence_dictionary_splits_at_underscore(spark):
    docs = spark.createDataFrame([("ITEM_85123A, ITEM_22",), ("item_22",)], "text string")
    assert {r["token"]: r["id"] for r in T.fit_vocab(docs, "text").collect()} == {"item": 1, "22": 2, "85123a": 3}


def test_mode_and_text(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",)], "x string")
    assert cleaning.column_mode(df, "x") == "a"
    text = spark.createDataFrame([("₹1,200.5 café",)], "t string")
    row = text.select(X.strip_symbols(F.col("t"), False), X.strip_symbols(F.col("t"))).first()
    assert tuple(row) == ("12005 café", "1200.5 café")


def test_numeric_sequence(spark):
    df = spark.createDataFrame([(1, "3.0, ,12.5"), (2, ""), (3, None)], "id int, s string")
    got = {r["id"]: [e["s"] for e in r["steps"]] for r in T.to_numeric_seq(df, ["id"], ["s"], 4).collect()}
    assert got == {1: [3.0, 0.0, 12.5, 0.0], 2: [0.0] * 4, 3: [0.0] * 4}


def test_missing_values(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,-\n-,x\n")
    df = read_table(spark, str(tmp_path / "t.csv"), "a int, b string", null_token="-")
    assert {tuple(r) for r in cleaning.fill_by_pattern(df, {"b": ""}).collect()} == {(1, ""), (-1, "x")}
    assert summary.null_counts(df).first().asDict() == {"a": 1, "b": 1}
    assert cleaning.drop_any_null(df).count() == 0
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "t.csv"))


def test_sentinels(spark):
    df = spark.createDataFrame([(1, "3.1"), (2, "NEW"), (3, "Opening Soon"), (4, "4.0")], "i int, rating string")
    flags = cleaning.sentinel_flags(df, "rating", {"NEW": "New", "Opening Soon": "Opening_Soon"})
    assert [tuple(r)[2:] for r in flags.orderBy("i").collect()] == [(0, 0), (1, 0), (0, 1), (0, 0)]
    nulled = cleaning.null_sentinels(df, "rating", ["NEW", "Opening Soon"])
    assert [r["rating"] for r in nulled.orderBy("i").collect()] == ["3.1", None, None, "4.0"]
    padded = cleaning.null_sentinels(df, "rating", ["NEW", "Opening Soon"], [F.asc("i")])
    assert [r["rating"] for r in padded.orderBy("i").collect()] == ["3.1", "3.1", "3.1", "4.0"]


def test_log_and_argmax(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.2)], "p double, q double, r double")
    assert df.select(C.argmax(["p", "q", "r"])).first()[0] == "p"
    assert df.select(C.log_shift(F.col("r") - 1, 0.1)).first()[0] is None


def test_class_weights(spark):
    df = spark.createDataFrame([(1, 0)] * 30 + [(0, 1)] + [(0, 0)] * 5, "a int, b int")
    got = {r["target"]: r["weight"] for r in sampling.class_weights(df, ["a", "b"], 0.3).collect()}
    assert got["a"] == 1.0 and got["b"] == pytest.approx(2.2300144, abs=1e-6)  # ln(0.3 * 31)


def test_numbers_and_sums_do_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 7919) % 1009)
    expected = {r["id"]: i for i, r in enumerate(sorted(df.collect(), key=lambda r: r["v"]))}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            got = {r["id"]: r["row_no"] for r in number_rows(df, [F.asc("v")], first=0).collect()}
            assert got == expected
            sums = running_sums(df, [F.asc("v")], {"v": "below"}).orderBy("v").collect()
            assert all(b["below"] == a["below"] + a["v"] for a, b in zip(sums, sums[1:]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_folds_cover_all_rows(spark):
    folds = sampling.kfold(spark.range(23), 10, [F.asc("id")]).groupBy("fold").count().collect()
    assert {r["fold"]: r["count"] for r in folds} == {**{i: 3 for i in range(3)}, **{i: 2 for i in range(3, 10)}}
