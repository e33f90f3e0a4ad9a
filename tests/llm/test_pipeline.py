"""Every stage on its own input against plain Python, and awkward tables through all of them."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.helpers import SF, awkward, documents, empty
from tests.llm.test_near_dedup import brute
from trolley.llm import language, toxicity


def stages(spark, docs):
    """(name, input rows, output) of each stage, as run() chains them."""
    out = []
    for name, stage in P.STAGES:
        made = stage(spark, docs, SF).cache()
        out.append((name, docs, made))
        docs = made
    return out


@pytest.fixture(scope="module")
def done(spark):
    return {name: (before, after) for name, before, after in stages(spark, documents(spark))}


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_columns_and_rows_are_kept(spark, done):
    first = documents(spark)
    for name, (before, after) in list(done.items())[:-1]:
        assert after.columns == first.columns
        assert after.join(first, first.columns, "left_anti").count() == 0, name


def test_toxicity_stage(spark, done):
    before, after = done["toxicity"]
    model = toxicity.learned(spark, SF, before)
    gone = {r["doc_id"] for r in toxicity.score(before, model).filter("score >= 0.7").collect()}
    assert ids(after) == sorted(set(ids(before)) - gone)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = labels.filter("toxic = 0 and crc32(cast(doc_id as string)) % 3 = 1")
    assert clean.join(after, "doc_id", "left_anti").count() <= 0.02 * clean.count() + 1


def test_language_stage(spark, done):
    before, after = done["language"]
    assert ids(after) == sorted(r["doc_id"] for r in before.collect() if any(c.isalpha() for c in r["text"] or ""))


def test_language_stage_uses_the_model(spark):
    """Noise goes although it has letters; every learned language and short texts stay."""
    docs = documents(spark)
    junk = ["qzxvkw jqpxz vvkqj zzxqw kjqxv pqzzx wqkjx " * 5, "\u4e00\u9fa5\u4e8c" * 40]
    good = ["the house was bought by the city last year", "la ciudad tiene una historia muy larga", "one", "x", "Total: 12.50 EUR, 2024-01-02 4088495698897153"]
    extra = spark.createDataFrame([(None, t) for t in junk + good], "doc_id long, text string")
    after = P.drop_unknown_language(spark, docs.unionByName(extra, allowMissingColumns=True), SF)
    assert sorted(r["text"] for r in after.filter("doc_id is null").collect()) == sorted(good)
    assert after.filter("doc_id is not null").count() == docs.filter("text rlike '\\\\p{L}'").count()


def test_exact_stage(spark, done):
    before, after = done["exact_dedup"]
    largest = {}
    for r in before.collect():
        largest[r["text"] or ""] = max(r["doc_id"], largest.get(r["text"] or "", r["doc_id"]))
    assert ids(after) == sorted(largest.values())


def test_near_stage(spark, done):
    before, after = done["near_dedup"]
    want = brute([(r["doc_id"], r["text"]) for r in before.collect()], 5)
    assert ids(after) == sorted({c for _, c in want.values()})


def test_packing_stage(spark, done):
    before, after = done["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in before.collect()}
    got = {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == want


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    found = {name: after for name, _, after in stages(spark, docs)}
    assert found["toxicity"].count() == docs.count()  # none of them is toxic
    assert ids(found["language"].filter("doc_id is not null")) == [1, 2, 6, 7, 10, 11, 11]
    assert ids(found["exact_dedup"].filter("doc_id is not null")) == [2, 7, 10, 11]
    assert found["near_dedup"].columns == docs.columns
    for _, _, after in stages(spark, empty(spark)):
        assert after.count() == 0


def test_registered(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert P.ORACLE_SQL is None and language.UNKNOWN == "und"
