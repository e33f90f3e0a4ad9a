"""Exact deduplication by a stream with disk-backed keyed state.

Arrivals (digest, id, locator: no text) are appended to a landing folder. A Structured
Streaming aggregation keyed by digest keeps, in RocksDB and without expiry, the stable
identifier of the row that stays, the number of rows and the locator of the content kept.
The answer is read out of that state. A hit is not trusted on its digest: the full bytes of
all rows of a digest with more than one row are compared, and a digest that turns out to hold
different texts is split by text.

Scale: only digests are shuffled, combined before the shuffle, so a text copied a billion times
is one row per input task. The byte comparison reads the hits only (their digests are broadcast
if their counted rows are within a bound, else joined) and groups (digest, text), again combined
before the shuffle. Each state partition lives on disk, so memory does not grow with the corpus. State and
landing folder are in the shared folder: a lost executor reloads its partitions from there, and a
later call with the same folder goes on where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trolley.llm.common import empty_text, few, scratch, stored, table

# State on disk; no preallocated logs, of which many small partitions would hold megabytes each.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def ingest(docs: DataFrame, state: str, text: str = "text", key: str = "doc_id",
           digest: Callable[[Column], Column] = sha256, where: Column | None = None) -> None:
    """Bring the rows of ``docs`` into the state kept in the folder ``state``. ``where`` says where a
    row's content lies (a plain file scan has ``input_file_name()``)."""
    spark, body = docs.sparkSession, empty_text(text)
    arrivals = docs.select(digest(body).alias("digest"), F.col(key).cast("long").alias("id"),
                           F.struct((F.lit(None) if where is None else where).cast("string").alias("file"), F.octet_length(body).cast("long").alias("n_bytes")).alias("locator"))
    arrivals.write.mode("append").parquet(f"{state}/arrivals")
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for k, v in STATE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        kept = (spark.readStream.schema(arrivals.schema).parquet(f"{state}/arrivals").groupBy("digest")
                .agg(F.max(F.struct("id", "locator")).alias("best"), F.count(F.lit(1)).alias("rows")))
        (kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{state}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """digest, keep_id, group_size, locator: one row per digest seen so far."""
    held = spark.read.format("statestore").load(f"{state}/checkpoint")
    best, rows = (f"value.`{f.name}`" for f in held.schema["value"].dataType.fields)
    return held.select("key.digest", F.col(f"{best}.id").alias("keep_id"), F.col(rows).alias("group_size"),
                       F.col(f"{best}.locator").alias("locator"))


def assign(docs: DataFrame, state: str, text: str = "text", key: str = "doc_id",
           digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. A null id is smaller than any other. Rows repeating both id and
    text cannot be told apart and carry the same values (``deduplicated`` keeps one of them).
    """
    body = empty_text(text)
    seen = stored(read_state(docs.sparkSession, state).drop("locator"), "seen")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), digest(body).alias("digest"), sha256(body).alias("sha"))
    # Full bytes on hits: all texts of every digest that more than one row has.
    hits = stored(seen.filter("group_size > 1").select("digest"), "hits")
    texts = (docs.select(digest(body).alias("digest"), body.alias("text"), F.col(key).cast("long").alias("id"))
             .join(few(hits), "digest", "left_semi").groupBy("digest", "text").agg(F.max("id").alias("own_keep"), F.count(F.lit(1)).alias("own_size"))
             .select("digest", sha256(F.col("text")).alias("sha"), "own_keep", "own_size"))
    texts = stored(texts, "texts")
    clashing = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    split = texts.join(clashing, "digest", "left_semi")
    return (rows.join(seen, "digest", "left").join(split, ["digest", "sha"], "left")
            .select("doc_id", F.when(F.col("own_size").isNull(), F.col("keep_id")).otherwise(F.col("own_keep")).alias("keep_id"),
                    F.coalesce("own_size", "group_size").alias("group_size"), F.lower(F.hex("sha")).alias("text_sha256"))
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def exact_dedup(docs: DataFrame, state: str | None = None, text: str = "text", key: str = "doc_id",
                digest: Callable[[Column], Column] = sha256, where: Column | None = None) -> DataFrame:
    """Ingest and assign in one call; an empty table gives an empty result."""
    state = state or scratch(docs.sparkSession, "exact-state")
    ingest(docs, state, text, key, digest, where)
    return assign(docs, state, text, key, digest)


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns; of rows repeating id and text, one."""
    verdict = stored(exact_dedup(docs, None, text, key), "verdict")
    sha, same = F.lower(F.hex(sha256(empty_text(text)))), ["__exact_id", "__exact_sha"]
    names = [F.col("doc_id").alias("__exact_id"), F.col("text_sha256").alias("__exact_sha")]
    gone = stored(verdict.filter("not kept").select(*names).distinct(), "gone")
    repeated = stored(verdict.filter("kept").groupBy(*names).count().filter("count > 1").select(*same), "repeated")
    rows = docs.withColumn("__exact_id", F.col(key).cast("long")).withColumn("__exact_sha", sha)

    def meets(other: DataFrame) -> Column:
        return rows["__exact_id"].eqNullSafe(other["__exact_id"]) & (rows["__exact_sha"] == other["__exact_sha"])

    gone, repeated = few(gone), few(repeated)
    once = rows.join(gone, meets(gone), "left_anti").join(repeated, meets(repeated), "left_anti")
    again = rows.join(repeated, meets(repeated), "left_semi").dropDuplicates(same)
    return once.unionByName(again).select(*docs.columns)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), where=F.input_file_name())


SQL = """SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
  count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept, sha256(coalesce(text, '')) AS text_sha256 FROM documents"""
