"""Source divergence audit: how far the vocabularies of a language's sources lie apart.

Every language keeps the terms that at least ``LEAST_DOCS`` of its documents hold. A source (within its
language) and the language itself give each kept term a smoothed share, in whole billionths, and all
arithmetic is on integers. Two reports follow:

* ``pair``: the summed absolute difference of shares between each two sources of a language.
* ``term``: the terms a source uses most beyond its language, the first ``TOP``.

The terms come from a dominance skyband: a term is out if ``TOP`` others have a group count at least as
high, a language count at most as high and an earlier UTF-8 form, for each of those is ranked before it.
Partitions, dealt by term, retain their own skyband; the skybands of a group are merged in the same way
and only what is left is ranked exactly. Rows reach a skyband in an order in which dominators come first,
so it is one pass whose state is two numbers per retained term.

Scale: texts are counted where they are read (bounded tables, flushed when full), so only (language,
source, term) sums are shuffled and a source or a word with a third of all rows is no hot group. A pair
of sources is compared block by block: at most ``SOURCES`` sources on either side and about ``TERMS``
terms make one task's matrix, only sums per pair come out, and their number is the result's own.

Rows: null text, lang and source count as ''. Repeated rows and ids are documents of their own. Of
further columns none is read. A group without terms has the shares of count 0; a language without kept
terms has pairs of value 0 and no term rows; an empty table has no row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from trolley.llm.common import empty_text, slices, stored, table, text_bytes

LEAST_DOCS, SMOOTH, UNIT, TOP = 30, 5, 1_000_000_000, 50
SOURCES, TERMS = 64, 1024       # a task's block of source pairs: sources a side, terms
FLUSH, PIECE = 800_000, 1 << 20  # entries of a counting table; bytes of a text looked at in one go

# Bytes of a term (letters of ASCII, and all bytes of other characters), lower-cased; others part terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


def tokens(data: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of one stretch each; no term is cut."""
    at = 0
    while at < len(data):
        cut = _BREAK.search(data, min(at + piece, len(data)))
        end = cut.start() if cut else len(data)
        yield data[at:end].translate(_FOLD).split(b" ")
        at = end + 1


def counted(docs: DataFrame, flush: int = FLUSH) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of each term in each group. A row with the
    empty term stands for each group."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, str], Counter] = {}
        df: dict[tuple[str, str], Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for group, counts in n.items():
                counts[b""] = df[group][b""] = 0
                own, size = df[group], len(counts)
                try:
                    terms = pa.array(list(counts), pa.binary()).cast(pa.string())
                except pa.ArrowInvalid:  # a text that is not UTF-8
                    terms = pa.array([t.decode("utf-8", "replace") for t in counts])
                yield pa.record_batch([pa.repeat(pa.scalar(group[0], pa.string()), size), pa.repeat(pa.scalar(group[1], pa.string()), size), terms,
                                       pa.array(list(counts.values()), pa.int64()), pa.array(list(map(own.__getitem__, counts)), pa.int64())], ["lang", "source", "term", "n", "df"])
            n.clear()
            df.clear()

        for batch in slices(batches, "text", 2000, 4 << 20):
            data, ends = text_bytes(batch.column(2))
            data, ends = data.tobytes(), ends.tolist()
            for lang, source, start, end in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ends[:-1], ends[1:]):
                group, own = (lang, source), set()
                total, docs_ = n.setdefault(group, Counter({b"": 0})), df.setdefault(group, Counter())
                for found in tokens(data[start:end]):
                    total.update(found)  # counts a list in C; adding up two counters would be a Python loop
                    own.update(found)
                docs_.update(own)
            if sum(map(len, n.values())) > flush:
                yield from out()
        yield from out()

    texts = docs.select(empty_text("lang").alias("lang"), empty_text("source").alias("source"), empty_text("text").alias("text"))
    parts = texts.mapInArrow(work, "lang string, source string, term string, n long, df long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: Column | str, total: str, kept: str) -> Column:
    """1 + floor(UNIT (count + SMOOTH) / (total + SMOOTH kept)), exactly."""
    return F.expr(f"1 + CAST({UNIT} AS DECIMAL(10, 0)) * CAST({count} + {SMOOTH} AS DECIMAL(20, 0)) div CAST({total} + {SMOOTH} * {kept} AS DECIMAL(20, 0))")


class Skyband:
    """Rows come in dominance order (group count down, language count up, term up): every dominator of a
    row comes before it. A row stays if fewer than k rows that stayed dominate it, which is the same as
    fewer than k of all rows: the first k dominators of any row stay themselves."""

    def __init__(self, k: int):
        self.k, self.n = k, 0
        self.counts, self.heads, self.terms = np.empty(1024, np.int64), np.empty(1024, np.uint64), []

    def stays(self, lang_count: int, term: bytes) -> bool:
        """Most dominators show by the first eight bytes; equal ones are compared in full."""
        head = int.from_bytes(term[:8].ljust(8, b"\0"), "big")
        lower, heads = self.counts[:self.n] <= lang_count, self.heads[:self.n]
        seen = np.count_nonzero(lower & (heads < head))
        if seen < self.k:
            seen += sum(self.terms[i] < term for i in np.flatnonzero(lower & (heads == head)))
        if seen >= self.k:
            return False
        if self.n == len(self.counts):
            self.counts, self.heads = (np.concatenate([x, np.empty_like(x)]) for x in (self.counts, self.heads))
        self.counts[self.n], self.heads[self.n] = lang_count, head
        self.terms.append(term)
        self.n += 1
        return True


def skyband(rows: DataFrame, k: int) -> DataFrame:
    """The k-skyband of each group among the rows of its partition. Columns lang, source, term, n, total."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, None
        for batch in batches:
            stay = []
            for i, (lang, source, term, total) in enumerate(zip(*[batch.column(j).to_pylist() for j in (0, 1, 2, 4)])):
                if (lang, source) != group:
                    group, band = (lang, source), Skyband(k)
                if band.stays(total, term.encode()):
                    stay.append(i)
            if stay:
                yield batch.take(pa.array(stay))

    ordered = rows.select("lang", "source", "term", "n", "total").sortWithinPartitions("lang", "source", F.desc("n"), "total", "term")
    return ordered.mapInArrow(work, rows.select("lang", "source", "term", "n", "total").schema)


def term_rows(kept: DataFrame, langs: DataFrame, sources: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank) of the terms a source uses most beyond its language."""
    def shared(rows: DataFrame) -> DataFrame:
        both = rows.join(sources.select("lang", "source", "sum"), ["lang", "source"]).join(langs, "lang")
        value = share("n", "sum", "kept") - share("total", "lang_sum", "kept")
        return both.withColumn("value", value.cast("long")).filter("value > 0").select(*rows.columns, "value")

    local = skyband(shared(kept.filter("n > 0").select("lang", "source", "term", "n", "total")).repartition(F.col("term")), top)
    merged = skyband(local.repartition("lang", "source"), top)
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = shared(merged).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def pair_rows(kept: DataFrame, langs: DataFrame, sources: DataFrame, block: int = SOURCES, terms: int = TERMS) -> DataFrame:
    """(lang, source, item, value, rank) over all pairs of a language's sources.

    Sources get a number within their language and lie in blocks of ``block``; terms lie in buckets by
    hash. Each (bucket, block, block) is one matrix; markers bring the sources' shares of count 0.
    """
    numbered = sources.join(langs.select("lang", "kept"), "lang").select(
        "lang", "source", "sum", "kept", (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).cast("long").alias("no"))
    numbered = stored(numbered.withColumn("zero", F.when(F.col("kept") > 0, share("0", "sum", "kept")).otherwise(0).cast("long")), "sources")
    sizes = stored(numbered.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"),
                                                (F.floor(F.max("kept") / terms) + 1).cast("long").alias("buckets")), "sizes")
    bucket = F.pmod(F.xxhash64("term"), F.col("buckets"))
    vocabulary = kept.select("lang", "term").distinct().join(sizes, "lang").groupBy("lang", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("size"))
    spans = sizes.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket")).join(vocabulary, ["lang", "bucket"], "left").na.fill(0, ["size"])

    def partners(rows: DataFrame) -> DataFrame:
        """A copy for each partner block, keyed by the lesser and the greater block."""
        own = F.floor(F.col("no") / block)
        spread = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        return spread.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))

    cells = (kept.filter("n > 0").join(numbered, ["lang", "source"]).join(sizes, "lang")
             .select("lang", bucket.alias("bucket"), "no", "blocks", F.xxhash64("term").alias("t"), share("n", "sum", "kept").cast("long").alias("p"), F.lit(0).cast("long").alias("size")))
    marks = numbered.join(sizes.drop("buckets"), "lang").join(spans, "lang").select("lang", "bucket", "no", "blocks", F.lit(None).cast("long").alias("t"), F.col("zero").alias("p"), "size")
    parts = partners(cells.unionByName(marks)).select("lang", "bucket", "a", "b", "no", "t", "p", "size")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        marker = rows["t"].isna()
        own = rows[marker].sort_values("no")
        nos, zeros, size = own["no"].to_numpy(np.int64), own["p"].to_numpy(np.int64), int(own["size"].iloc[0])
        a, b = int(rows["a"].iloc[0]), int(rows["b"].iloc[0])
        cell = rows[~marker]
        _, t = np.unique(cell["t"].to_numpy(np.int64), return_inverse=True)
        present = int(t.max()) + 1 if len(t) else 0
        shares = np.repeat(zeros[:, None], present, 1)
        shares[np.searchsorted(nos, cell["no"].to_numpy(np.int64)), t] = cell["p"].to_numpy(np.int64)
        left, right = np.flatnonzero(nos // block == a), np.flatnonzero(nos // block == b)
        out = []
        for i in left:
            far = np.abs(shares[right] - shares[i]).sum(1) + (size - present) * np.abs(zeros[right] - zeros[i])
            out.append(pd.DataFrame({"i": nos[i], "j": nos[right], "value": far}))
        found = pd.concat(out)
        found = found[found["i"] < found["j"]] if a == b else found
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "i": found["i"], "j": found["j"], "value": found["value"]})

    sums = (parts.groupBy("lang", "bucket", "a", "b").applyInPandas(compare, "lang string, i long, j long, value long")
            .groupBy("lang", "i", "j").agg(F.sum("value").alias("value")))
    both = sums.select("lang", "value", F.explode(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))).alias("e")).select("lang", "value", "e.*")
    named = (both.join(numbered.select("lang", F.col("no").alias("i"), "source"), ["lang", "i"])
             .join(numbered.select("lang", F.col("no").alias("j"), F.col("source").alias("item")), ["lang", "j"]))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.select("lang", "source", "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """One row per (lang, source, part, item): lang, source, part, item, value long, rank int."""
    counts = stored(counted(docs), "counts")
    vocabulary = counts.filter("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("df").alias("df")).filter(F.col("df") >= least_docs)
    vocabulary = stored(vocabulary.select("lang", "term", "total"), "vocabulary")
    kept = stored(counts.filter("term <> ''").join(vocabulary, ["lang", "term"]).select("lang", "source", "term", "n", "total"), "kept")
    none = F.lit(0).cast("long")
    groups = counts.select("lang", "source").distinct()
    langs = groups.select("lang").distinct().join(vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_sum")), "lang", "left")
    langs = stored(langs.select("lang", *[F.coalesce(c, none).alias(c) for c in ("kept", "lang_sum")]), "langs")
    sources = groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("sum")), ["lang", "source"], "left")
    sources = stored(sources.select("lang", "source", F.coalesce("sum", none).alias("sum")), "groups")
    parts = [rows.withColumn("part", F.lit(part)) for part, rows in (("pair", pair_rows(kept, langs, sources)), ("term", term_rows(kept, langs, sources, top)))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


_P = "CAST(1 + (1000000000::HUGEINT * ({c} + 5)) // ({n} + 5 * v) AS BIGINT)"

SQL = r"""WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
 words AS (SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
 per_doc AS (SELECT id, lang, source, term, count(*) AS n FROM words GROUP BY ALL),
 vocab AS (SELECT lang, term, CAST(sum(n) AS BIGINT) AS total FROM per_doc GROUP BY lang, term HAVING count(*) >= 30),
 langs AS (SELECT lang, coalesce(v, 0) AS v, coalesce(n, 0) AS lang_sum FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN (SELECT lang, count(*) AS v, sum(total) AS n FROM vocab GROUP BY lang) USING (lang)),
 counts AS (SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n FROM per_doc SEMI JOIN vocab USING (lang, term) GROUP BY ALL),
 grps AS (SELECT lang, source, coalesce(n, 0) AS s FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) USING (lang, source)),
 shares AS (SELECT lang, source, term, total, coalesce(n, 0) AS n, """ + _P.format(c="coalesce(n, 0)", n="s") + " AS p, " + _P.format(c="total", n="lang_sum") + r""" AS q
  FROM grps JOIN langs USING (lang) JOIN vocab USING (lang) LEFT JOIN counts USING (lang, source, term)),
 far AS (SELECT x.lang, x.source, y.source AS item, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
 pairs AS (SELECT x.lang, x.source, y.source AS item, coalesce(value, 0) AS value FROM grps x JOIN grps y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN far ON far.lang = x.lang AND far.source = x.source AND far.item = y.source),
 both_parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
 SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts) WHERE part = 'pair' OR rank <= 50"""
