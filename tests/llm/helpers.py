"""Tables with the awkward rows every operator must take."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, digest string, label int, score double, component string"
LONG = " ".join(f"word{i % 977} the" for i in range(40_000))


def awkward(spark):
    """Nulls in any column, empty and very long texts, repeated rows, clashing extra columns."""
    texts = [(1, "the cat sat on the mat today and slept"), (2, "the cat sat on the mat today and slept"), (3, None), (4, ""), (5, ""), (6, LONG), (7, LONG),
             (8, "1234 5678"), (9, " \t\n "), (10, "Ünïcode ﬁgures İ ΣΑΣ 日本語 \u0000 <|endoftext|> ok"), (11, "one"), (11, "one"), (None, "one"), (None, None)]
    return spark.createDataFrame([(i, t, None if i in (3, None) else "en", None, "x", None, 0.5, None) for i, t in texts], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")
