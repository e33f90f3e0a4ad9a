"""The corpus pipeline: filter, deduplicate and pack the documents.

Each stage reads all rows that the one before kept, from Parquet, and its decision takes effect.
All but the last return the columns of ``documents``. The stages bound the session's Arrow batches by bytes.

* toxicity: rows that the classifier predicts toxic go; every other row stays.
* language: rows without an identifiable language go: those without a letter or null, also where no
  language could be learned, and those that the language model finds to be noise.
* exact_dedup: of equal texts the row with the largest id stays.
* near_dedup: of documents linked by 0.8 similarity of five-word shingles, the smallest id stays.
* packing: pieces of windows of 2048 tokens.

The first two judge every row by its own text, whatever its id. Nulls, empty and very long texts, repeated rows and empty tables are as the operators define them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trolley.llm import exact_dedup, language, near_dedup, packing, toxicity
from trolley.llm.common import bounded_batches, scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return toxicity.clean(docs, toxicity.learned(spark, sf_dir, docs))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return language.identified(docs, language.learned(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return near_dedup.deduplicated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return packing.digests(packing.pack(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

# Model scores and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
