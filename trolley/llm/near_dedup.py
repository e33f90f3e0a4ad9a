"""MinHash near-duplicates with sequential Bayesian verification.

1. Every document gets its set of word shingles, a fingerprint of that set and a MinHash
   signature. Documents with equal sets are one class; only its smallest id goes on.
2. Signatures are cut into bands. In each band bucket, members are paired with two pivots (the
   smallest and the largest id), which is linear in the bucket.
3. A pair's signatures are compared batch by batch. After m of n equal values the posterior of
   the similarity is Beta(m + 1, n - m + 1); the pair is dropped as soon as the posterior
   probability of reaching the threshold is below ``miss``.
4. Survivors are verified on the full shingle sets, first the best pair of each document, then
   the pairs that still join different components.
5. What pivots could miss: members of one bucket that are by now in different components are all
   compared, by the same steps 3 and 4. In buckets of up to ``SMALL`` members these pairs are a
   join, whose size is at most ``SMALL`` times its input. Documents connected through larger
   buckets form a hot group; those outside its largest component are compared with the whole group
   in blocks of bounded size, inside tasks, and only links come out. After that no candidate pair
   between different components is left unchecked, whatever the size of a bucket.

A pair at the threshold shares no band with probability (1 - t^rows)^bands, 1.3e-7 by default;
``miss`` is a further 1e-9 per look. Shingles are 64-bit hashes, so a set of n shingles has two
equal hashes by chance with probability n^2 / 3.7e19.

Scale: text is read twice (all of it for signatures, candidates' texts for verification) and never
shuffled unless candidates outgrow a checked broadcast. Hot buckets and classes are split by the
skew join; no group is collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trolley.llm.common import empty_text, few, slices, stored, table, text_bytes
from trolley.llm.graph import components
from trolley.llm.shingles import mix, shingle_sets

BANDS, ROWS, BATCH, MISS = 40, 5, 25, 1e-9
SMALL, BLOCK = 48, 256  # members of a bucket whose pairs are joined; documents a block holds on average
PIECE = 1 << 20         # bytes of text whose shingles are made in one go (a longer text is one piece)
_SEED = 7_919


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(_SEED)
    return draw.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), draw.integers(0, 2**32, n, dtype=np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest value of each permutation over a non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(out, (a[:, None] * x[None, at:at + 1024] + b[:, None]).min(1), out)
    return out


def least_matches(looks: list[int], threshold: float, miss: float) -> list[int]:
    """Per number n of compared values, the smallest m whose posterior chance of reaching the
    threshold is at least ``miss``: P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m)."""
    out = []
    for n in looks:
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


SIGNED = "doc_id long, n_shingles long, fingerprint binary, signature binary"


def signed(docs: DataFrame, text: str, key: str, width: int, perms: int) -> DataFrame:
    """doc_id, n_shingles, fingerprint of the set, signature (null for an empty set)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations(perms)
        for piece in slices(batches, "text", 2000, PIECE):
            sets, bounds = shingle_sets(*text_bytes(piece.column(1)), width)
            own = [sets[s:e] for s, e in zip(bounds[:-1], bounds[1:])]
            yield pa.record_batch([
                piece.column(0), pa.array(np.diff(bounds)),
                pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in own], pa.binary()),
                pa.array([signature(x, a, b).tobytes() if len(x) else None for x in own], pa.binary())],
                ["doc_id", "n_shingles", "fingerprint", "signature"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), empty_text(text).alias("text")).mapInArrow(work, SIGNED)


def banded(reps: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, doc_id): one row per document and band."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.frombuffer(text_bytes(batch.column(1))[0], np.uint32).reshape(batch.num_rows, -1)[:, :bands * rows]
                values = values.reshape(batch.num_rows, bands, rows).astype(np.uint64)
                hashed = np.arange(1, bands + 1, dtype=np.uint64)[None, :].repeat(batch.num_rows, 0)
                for j in range(rows):
                    hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + values[:, :, j])
                yield pa.record_batch([pa.array(hashed.reshape(-1).view(np.int64)),
                                       pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), bands))], ["band", "doc_id"])

    return reps.select("doc_id", "signature").mapInArrow(work, "band long, doc_id long")


def surviving(left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray, looks: list[int], least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(pairs that stay, their equal values) of the pairs left[x], right[y], batch by batch."""
    alive, matches, done = np.arange(len(x)), np.zeros(len(x), np.int64), 0
    for n, m in zip(looks, least):
        matches += (left[x[alive], done:n] == right[y[alive], done:n]).sum(1)
        stay, done = matches >= m, n
        alive, matches = alive[stay], matches[stay]
    return alive, matches


def promising(pairs: DataFrame, reps: DataFrame, threshold: float, looks: list[int], least: list[int]) -> DataFrame:
    """(a, b, matches) of the pairs whose posterior bound holds after every batch of values."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            left, right = (np.frombuffer(text_bytes(rows.column(i))[0], np.uint32).reshape(rows.num_rows, -1) for i in (4, 5))
            small, large = (f(rows.column(2).to_numpy(), rows.column(3).to_numpy()) for f in (np.minimum, np.maximum))
            near = np.flatnonzero(small >= threshold * large * (1 - 1e-9))  # |A| / |B| bounds the similarity
            alive, matches = surviving(left, right, near, near, looks, least)
            chosen = pa.array(near[alive])
            yield pa.record_batch([rows.column(0).take(chosen), rows.column(1).take(chosen), pa.array(matches)], ["a", "b", "matches"])

    side = {x: reps.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("signature").alias(f"s{x}")) for x in "ab"}
    return (pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "na", "nb", "sa", "sb")
            .mapInArrow(work, "a long, b long, matches long"))


def set_rows(docs: DataFrame, ids: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """(doc_id, set) of the documents in ``ids``: all shingles, sorted, as 64-bit values."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 2000, PIECE):
            sets, bounds = shingle_sets(*text_bytes(piece.column(1)), width)
            yield pa.record_batch([piece.column(0), pa.array([sets[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:])], pa.binary())], ["doc_id", "shingles"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), empty_text(text).alias("text"))
    return rows.join(few(ids), "doc_id", "left_semi").mapInArrow(work, "doc_id long, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * |intersection| >= percent * |union| on the full sets."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keep = []
            for i in range(rows.num_rows):
                x, y = (np.frombuffer(rows.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                place = np.searchsorted(y, x)
                place[place == len(y)] = 0
                both = int((y[place] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([c.filter(pa.array(keep, pa.bool_())) for c in rows.columns[:2]], ["a", "b"])

    side = {x: sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab"}
    return pairs.select("a", "b").join(side["b"], "b").join(side["a"], "a").select("a", "b", "sa", "sb").mapInArrow(work, "a long, b long")


def hot_groups(rows: DataFrame) -> DataFrame:
    """(doc_id, hot, component, asks): documents connected through the large buckets of ``rows``; those
    that ask are outside the largest component of their hot group."""
    if rows.isEmpty():
        return rows.select("doc_id", F.col("doc_id").alias("hot"), "component", F.lit(True).alias("asks"))
    leads = stored(rows.groupBy("band").agg(F.min("doc_id").alias("a")), "leads")
    groups = components(rows.join(few(leads), "band").select("a", F.col("doc_id").alias("b")))
    members = stored(rows.select("doc_id", "component").distinct().join(groups.select(F.col("node").alias("doc_id"), F.col("component").alias("hot")), "doc_id"), "hot-members")
    largest = members.groupBy("hot", "component").count().groupBy("hot").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    return members.join(largest, "hot").select("doc_id", "hot", "component", (F.col("component") != F.col("main")).alias("asks"))


def blockwise(hot: DataFrame, reps: DataFrame, sets: DataFrame, threshold: float, percent: int, looks: list[int], least: list[int]) -> DataFrame:
    """Links (a, b) between different components of each hot group: blocks of asking documents
    against blocks of the whole group, each pair of blocks one bounded group."""
    sizes = hot.groupBy("hot").agg(F.ceil(F.sum(F.col("asks").cast("int")) / BLOCK).alias("asking"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("asked")).filter("asking > 0")
    rows = (hot.join(sizes, "hot").join(reps.select("doc_id", "signature"), "doc_id").join(sets, "doc_id")
            .withColumn("draw", F.xxhash64("doc_id")))
    held = F.struct("doc_id", "component", "signature", "shingles")
    asking = rows.filter("asks").select("hot", F.pmod("draw", "asking").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("asked") - 1)).alias("y"), F.lit(True).alias("asks"), held.alias("d"))
    asked = rows.select("hot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("asking") - 1)).alias("x"), F.pmod("draw", "asked").alias("y"), F.lit(False).alias("asks"), held.alias("d"))
    blocks = asking.unionByName(asked).groupBy("hot", "x", "y").agg(F.collect_list(F.struct("asks", "d")).alias("members"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                members = batch.column(0).slice(i, 1).flatten()
                asks, held_ = members.field(0).to_numpy(zero_copy_only=False), members.field(1)
                ids, component = held_.field(0).to_numpy(), held_.field(1).to_numpy()
                values = np.frombuffer(text_bytes(held_.field(2))[0], np.uint32).reshape(len(ids), -1)
                own = [np.frombuffer(b.as_buffer(), np.uint64) for b in held_.field(3)]
                size = np.array([len(o) for o in own])
                left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
                for a in left:
                    near = right[(component[right] != component[a]) & (np.minimum(size[right], size[a]) >= threshold * np.maximum(size[right], size[a]) * (1 - 1e-9))]
                    alive, _ = surviving(values, values, np.full(len(near), a), near, looks, least)
                    near = near[alive]
                    if len(near):
                        every = np.concatenate([own[b] for b in near])
                        place = np.minimum(np.searchsorted(own[a], every), len(own[a]) - 1)
                        both = np.add.reduceat(own[a][place] == every, np.cumsum(size[near]) - size[near], dtype=np.int64)
                        found = near[100 * both >= percent * (size[a] + size[near] - both)]
                        yield pa.record_batch([pa.array(np.minimum(ids[a], ids[found])), pa.array(np.maximum(ids[a], ids[found]))], ["a", "b"])

    return blocks.select("members").mapInArrow(work, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS, batch: int = BATCH, miss: float = MISS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over links),
    kept.

    Null and empty texts have no shingles and are linked with nothing. A row with a null id is
    linked with nothing, has a null component and is kept. Rows sharing an id are one document.
    An empty table gives an empty result.
    """
    threshold, looks = percent / 100, [*range(batch, bands * rows, batch), bands * rows]
    least = least_matches(looks, threshold, miss)
    sign = stored(signed(docs, text, key, width, bands * rows), "signed")
    usable = sign.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(usable.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), "classes")
    reps = stored(usable.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
                  .dropDuplicates(["doc_id"]).select("doc_id", "n_shingles", "signature"), "reps")

    band_rows = stored(banded(reps, bands, rows), "bands")
    pivots = (band_rows.groupBy("band").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high"))
    shared = stored(band_rows.join(pivots, "band"), "shared")  # rows of buckets with two members or more
    pairs = stored(shared.select("doc_id", F.explode(F.array("low", "high")).alias("pivot")).filter("doc_id != pivot")
             .select(F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b")).distinct(), "pairs")
    candidates = stored(promising(pairs, reps, threshold, looks, least), "candidates")
    tested = set_rows(docs, stored(candidates.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids"), text, key, width)
    sets = stored(tested, "sets")

    best = candidates.groupBy("b").agg(F.max_by("a", F.struct("matches", "a")).alias("a")).select("a", "b")
    links = stored(verified(best, sets, percent), "links")
    belongs = stored(components(links), "components")
    rest = crossing(candidates.select("a", "b").join(best, ["a", "b"], "left_anti"), belongs)
    links = links.unionByName(stored(verified(rest, sets, percent), "links"))
    belongs = stored(components(links), "components")

    # Members of a bucket that are still apart, whoever the pivots were.
    apart = with_component(shared.select("band", "doc_id"), belongs)
    mixed = (apart.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("members"))
             .filter("least < most").select("band", "members"))
    apart = stored(apart.join(few(stored(mixed, "mixed")), "band"), "apart")
    left, right = (apart.filter(F.col("members") <= SMALL).select("band", F.col("doc_id").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    more = left.join(right, "band").filter("a < b and ca != cb").select("a", "b").distinct()
    more = stored(promising(more, reps, threshold, looks, least), "candidates")
    hot = stored(hot_groups(apart.filter(F.col("members") > SMALL)), "hot")
    ids = stored(more.select(F.explode(F.array("a", "b")).alias("doc_id")).unionByName(hot.select("doc_id")).distinct(), "ids")
    if not ids.isEmpty():
        sets = stored(set_rows(docs, ids, text, key, width), "sets")
        links = links.unionByName(stored(verified(more, sets, percent), "links")).unionByName(
            stored(blockwise(hot, reps, sets, threshold, percent, looks, least), "links"))
        belongs = stored(components(links), "components")

    named = sign.select("doc_id", "n_shingles", "fingerprint").join(classes, "fingerprint", "left")
    named = named.join(belongs.withColumnRenamed("node", "rep"), "rep", "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return named.select("doc_id", "n_shingles", found.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def with_component(rows: DataFrame, belongs: DataFrame) -> DataFrame:
    return rows.join(belongs.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def crossing(pairs: DataFrame, belongs: DataFrame) -> DataFrame:
    """The pairs whose two documents are in different components."""
    side = {x: belongs.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab"}
    joined = pairs.join(side["a"], "a", "left").join(side["b"], "b", "left")
    return joined.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component."""
    gone = stored(near_duplicates(docs, text, key, **options).filter("not kept").select(F.col("doc_id").alias(key)).distinct(), "gone")
    return docs.join(few(gone), key, "left_anti").select(*docs.columns)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)
