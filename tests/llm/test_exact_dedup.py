import hashlib

from pyspark.sql import functions as F

from tests.llm.helpers import awkward, documents, empty
from trolley.llm import exact_dedup as X


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["text"] or "", []).append(r["doc_id"])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_groups_and_awkward_rows(spark):
    for docs in (documents(spark), awkward(spark)):
        assert got(X.exact_dedup(docs)) == brute(docs.collect())


def test_empty_table(spark):
    assert X.exact_dedup(empty(spark)).count() == 0
    assert X.deduplicated(empty(spark)).count() == 0


def test_full_bytes_decide_where_digests_clash(spark):
    weak = lambda text: F.substring(F.hex(F.crc32(text)), 1, 1).cast("binary")
    docs = documents(spark)
    assert got(X.exact_dedup(docs, digest=weak)) == brute(docs.collect())


def test_state_goes_on_with_later_arrivals(spark, tmp_path):
    docs = documents(spark)
    first, second = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    X.ingest(first, str(tmp_path))
    X.ingest(second, str(tmp_path))
    assert got(X.assign(docs, str(tmp_path))) == brute(docs.collect())


def test_one_row_of_each_text_stays(spark):
    docs = awkward(spark)
    kept = X.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r["text"] or "") for r in kept.collect()) == sorted({(r["text"] or "") for r in docs.collect()})


def test_hot_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    assert got(X.exact_dedup(docs)) == brute(docs.collect())
