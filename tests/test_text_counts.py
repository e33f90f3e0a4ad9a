from pyspark.sql import functions as F

from trolley.functions import text as X
from trolley.operators import text as T


def test_counts_of_single_rows_equal_the_shuffled_ones(spark):
    """Keys on one row, on several, and missing ones; n-grams, texts that are empty or missing."""
    rows = [(1, "a b a b"), (2, "b c"), (2, "c d"), (3, ""), (4, None), (None, "a b"), (None, "a"), (5, "x"), (5, "x")]
    docs = spark.createDataFrame(rows, "id int, text string")
    want, got = (sorted((str(r["id"]), r["term"], r["tf"]) for r in T.term_counts(docs, ["id"], "text", lambda t: X.words(t, X.WORDS_1PLUS), (1, 2, 3), single=s).collect()) for s in (False, True))
    assert got == want and ("None", "a", 2) in got and ("1", "a b", 2) in got


def test_single_rows_are_not_shuffled(spark):
    docs = spark.range(20).select("id", F.lit("a b c").alias("text"))
    assert "Exchange" not in T.term_counts(docs, ["id"], "text", single=True)._jdf.queryExecution().executedPlan().toString()
