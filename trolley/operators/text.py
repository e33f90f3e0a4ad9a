"""TF-IDF and token-id features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from trolley.functions.text import ngrams, sequence_tokens, words
from trolley.operators.ordering import joined_on, number_rows, repeated_keys
from trolley.session import materialise

# Fixed value: longest padded sequence the models take.
MAX_STEPS = 60


@dataclass(frozen=True)
class Tfidf:
    """A fitted vocabulary ``(term, df, idf)`` and the number of documents behind it."""

    vocabulary: DataFrame
    documents: int


def term_counts(df: DataFrame, keys: Sequence[str], text: str, tokens: Callable[[Column], Column] = words,
                sizes: Sequence[int] = (1,), single: bool = False) -> DataFrame:
    """Frequency of each token, or n-gram of the given sizes, per document. A document may be
    spread over many rows (the purchases of a customer): only counts are shuffled, so no row
    ever holds the joined text. With ``single`` most documents are expected on one row: those
    are counted where they lie, and only the counts of keys that occur more often are shuffled."""
    split = df.select(*keys, tokens(F.col(text)).alias("_tokens"))
    if not single:
        return (split.select(*keys, F.explode(ngrams(F.col("_tokens"), sizes)).alias("term"))
                .groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf")))
    fields = [f for f in split.schema.fields if f.name != "_tokens"]
    counted = split.mapInArrow(_counter(len(keys), sizes), T.StructType([*fields, T.StructField("_terms", T.ArrayType(T.StringType())), T.StructField("_tf", T.ArrayType(T.LongType()))]))
    rows = counted.select(*keys, F.explode(F.arrays_zip("_terms", "_tf")).alias("_c")).select(*keys, F.col("_c._terms").alias("term"), F.col("_c._tf").alias("tf"))
    more = repeated_keys(df, keys)
    if more is None:
        return rows
    again = joined_on(rows, more, keys, "left_semi").groupBy(*keys, "term").agg(F.sum("tf").alias("tf"))
    return joined_on(rows, more, keys, "left_anti").unionByName(again)


def _counter(keys: int, sizes: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each row's distinct n-grams and how often it has them, in place of its tokens; few rows at a time."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                terms, times = [], []
                for found in part.column(keys).to_pylist():
                    found, seen = found or [], Counter()
                    for n in sizes:
                        seen.update(found if n == 1 else map(" ".join, zip(*[found[i:] for i in range(n)])))
                    terms.append(list(seen))
                    times.append(list(seen.values()))
                yield pa.record_batch([*part.columns[:keys], pa.array(terms, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))], [*part.schema.names[:keys], "_terms", "_tf"])

    return work


def tfidf_fit(counts: DataFrame, documents: int, min_df: int = 1, copies: int = 1) -> Tfidf:
    """Smoothed inverse document frequency: ln((1 + n) / (1 + df)) + 1.

    ``copies`` is how often each document occurs where a customer's list is repeated on
    several rows; it scales n and df without repeating the rows.
    """
    found = counts.groupBy("term").agg((F.count(F.lit(1)) * copies).alias("df"))
    kept = found if min_df <= 1 else found.filter(F.col("df") >= min_df)
    idf = F.log((1 + F.lit(documents * copies)) / (1 + F.col("df"))) + 1
    return Tfidf(kept.select("term", "df", idf.alias("idf")), documents)


def tfidf_transform(model: Tfidf, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """L2-normalised weights ``(keys, term, weight)``; terms outside the vocabulary are ignored."""
    known = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    raw = materialise(counts.filter(known).join(model.vocabulary.select("term", "idf"), "term").select(*keys, "term", "tf", "idf"), "raw")
    # A document has a term once, so it holds no more rows than the vocabulary has terms.
    squares = F.sum(F.col("tf") * F.col("idf") * F.col("tf") * F.col("idf")).over(W.partitionBy(*keys))
    return raw.select(*keys, "term", (F.col("tf") * F.col("idf") / F.sqrt(squares)).alias("weight"))


def tfidf_wide(weights: DataFrame, keys: Sequence[str], terms: Sequence[str], prefix: str = "tfidf_") -> DataFrame:
    """One column per listed term, 0 where the document lacks it. The columns are as many as the terms:
    for a large vocabulary list the terms that are wanted, or keep the long form."""
    wide = weights.groupBy(*keys).pivot("term", list(terms)).agg(F.first("weight"))
    return wide.select(*keys, *[F.coalesce(F.col(f"`{t}`"), F.lit(0.0)).alias(f"{prefix}{t}") for t in terms])


def fit_vocab(df: DataFrame, text: str, tokens: Callable[[Column], Column] = sequence_tokens) -> DataFrame:
    """Token dictionary: ids from 1 by falling frequency, ties in token order."""
    counts = (df.select(F.explode(tokens(F.col(text))).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    return number_rows(counts, [F.desc("n"), F.asc("token")], "id")


def max_len(df: DataFrame, text: str, tokens: Callable[[Column], Column] = sequence_tokens) -> DataFrame:
    return df.agg(F.max(F.size(tokens(F.col(text)))).cast("long").alias("max_len"))


def padding_length(df: DataFrame, text: str, limit: int = MAX_STEPS) -> int:
    """Length the dictionary's sequences are padded to: the longest one, at most ``limit``."""
    return min(max_len(df, text).first()["max_len"] or 0, limit)


def to_padded_ids(df: DataFrame, keys: Sequence[str], text: str, vocab: DataFrame, maxlen: int,
                  tokens: Callable[[Column], Column] = sequence_tokens) -> DataFrame:
    """Fixed-size id arrays: unknown tokens dropped, the last ``maxlen`` kept, zeros at the end.

    Keeping the last ones *is* the defined truncation; it runs as a per-document row limit
    before the shuffle, so a very long document is never gathered whole.
    """
    placed = df.select(*keys, F.posexplode(tokens(F.col(text))).alias("_pos", "_token"))
    known = placed.join(vocab.select(F.col("token").alias("_token"), F.col("id").alias("_id")), "_token")
    last = W.partitionBy(*keys).orderBy(F.desc("_pos"))
    kept = known.withColumn("_back", F.row_number().over(last)).filter(F.col("_back") <= maxlen)
    ids = kept.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_pos", "_id"))).alias("_ids"))
    found = F.coalesce(F.transform("_ids", lambda e: e["_id"]), F.array().cast("array<bigint>"))
    return (df.select(*keys).join(ids, list(keys), "left")
            .select(*keys, pad_right(found, maxlen, F.lit(0).cast("bigint")).alias("ids")))


def pad_right(values: Column, length: int, filler: Column) -> Column:
    return F.slice(F.concat(values, F.array_repeat(filler, length)), 1, length)


def truncate_left(values: Column, length: int) -> Column:
    """The last ``length`` entries."""
    return F.slice(values, F.greatest(F.size(values) - length, F.lit(0)) + 1, length)


def to_numeric_seq(df: DataFrame, keys: Sequence[str], columns: Sequence[str], maxlen: int = MAX_STEPS,
                   sep: str = ",") -> DataFrame:
    """``steps``: maxlen entries of one number per column, blanks and missing steps as 0."""
    def numbers(column: str) -> Column:
        first = F.slice(F.split(F.coalesce(F.col(column), F.lit("")), sep), 1, maxlen)
        parsed = F.transform(first, lambda t: F.coalesce(F.trim(t).try_cast("double"), F.lit(0.0)))
        return pad_right(parsed, maxlen, F.lit(0.0)).alias(column)

    return (df.select(*keys, *[numbers(c) for c in columns])
            .select(*keys, F.arrays_zip(*[F.col(c) for c in columns]).alias("steps")))
