"""Language-model scores of whole documents by a gated recurrent model.

1. Tokens of all training documents are counted (a Spark aggregation). The commonest words are the
   head of the model; every other word belongs to a tail class by its first two bytes, and inside
   its class has the counted probability (c + 0.1) / (N_class + 0.1 (V_class + 1)).
2. The recurrent model (``gru``) starts at the counted frequencies and is trained by truncated
   backpropagation: each replica goes through its documents window by window, replicas are averaged
   in a tree, and the next round starts from the average. Replicas follow from the number of tokens.
   Every training document is trained on once: the rounds are disjoint draws by the hash of the id
   (``share`` below one trains on fewer; counts cover all of them either way).
3. Scoring deals the documents of a batch to lanes and carries the state over all windows of a
   document. Counts of the words beyond the broadcast table are joined.

Words are known by 64-bit hashes of their bytes: among 10 million different words two share a hash
with probability 3e-6.

Scale: the model, the class totals and the table of frequent words (at most ``FREQUENT``) are
bounded; all other counts stay in Spark. Texts are read for counting, training and scoring and never
shuffled; only (word, count) and rare (document, word) pairs are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trolley.llm import gru
from trolley.llm.common import empty_text, id_bucket, slices, stored, table, text_bytes
from trolley.llm.shingles import _LOWER, mix, word_hashes, words

HEAD, CLASSES, TAILS, HIDDEN = 4096, 32, 64, 24
FREQUENT = 262_144      # words whose counts every task holds (16 bytes each)
SHARE, ROUNDS, REPLICA_TOKENS = 1.0, 2, 1_500_000
LANES, STEPS, RATE = 256, 20, 0.12
SMOOTH, END, _SEED = 0.1, 0, 3_001
_TAIL = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(TAILS)).astype(np.int32)  # of a word's first two bytes


@dataclass(frozen=True)
class Vocabulary:
    head: np.ndarray      # hashes by falling count
    known: np.ndarray     # sorted hashes of the frequent words, head included
    counts: np.ndarray    # of ``known``
    place: np.ndarray     # of ``known``: number in the head, or -1
    tail_log: np.ndarray  # log10(N_class + 0.1 (V_class + 1)) of each tail class
    total: int
    distinct: int

    @property
    def end(self) -> int:
        return int(np.flatnonzero(self.head == END)[0])

    @cached_property
    def _starts(self) -> tuple[np.uint64, np.ndarray]:
        """(shift, the first place in ``known`` not below each value of a hash's upper bits)."""
        bits = max(1, (4 * len(self.known) - 1).bit_length())
        lowest = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        return np.uint64(64 - bits), np.searchsorted(self.known, lowest).astype(np.int32)

    def find(self, found: np.ndarray) -> np.ndarray:
        """Places of hashes in ``known``, or -1."""
        shift, starts = self._starts
        at, last = starts[(found >> shift).view(np.int64)], len(self.known) - 1
        np.minimum(at, last, out=at)
        below = np.flatnonzero(self.known[at] < found)
        while len(below):  # on to the next of the few that share their upper bits
            at[below] += 1
            below = below[at[below] <= last]
            below = below[self.known[at[below]] < found[below]]
        np.minimum(at, last, out=at)
        at[self.known[at] != found] = -1
        return at


@dataclass(frozen=True)
class Model:
    words: Vocabulary
    layout: gru.Layout
    weights: dict[str, np.ndarray]
    rare: DataFrame  # (word, c) of all words beyond the frequent ones


def hashed(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, tail classes, word bounds of the documents); no hash is END."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(len(ends), np.int64)
    starts, stops = words(data, ends)
    found = np.maximum(word_hashes(data, starts, stops), np.uint64(1))
    second = _LOWER[data[np.minimum(starts + 1, len(data) - 1)]]
    second[stops - starts == 1] = 0
    return found, _TAIL[_LOWER[data[starts]].astype(np.uint16) << np.uint16(8) | second], np.searchsorted(starts, ends)


def counted(rows: DataFrame) -> DataFrame:
    """(word, tail, c) over all texts; each text has one END."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 4000, 4 << 20):
            found, tail, _ = hashed(*text_bytes(piece.column(0)))
            coded = pa.array(found.view(np.int64)).dictionary_encode()
            word, code = coded.dictionary.to_numpy(), coded.indices.to_numpy()
            at = np.empty(len(word), np.int64)
            at[code] = np.arange(len(code))  # a place of each word
            yield pa.record_batch([pa.array(np.append(word, np.int64(END))), pa.array(np.append(tail[at], 0).astype(np.int32)),
                                   pa.array(np.append(np.bincount(code, minlength=len(word)), piece.num_rows))], ["word", "tail", "c"])

    return rows.select("text").mapInArrow(work, "word long, tail int, c long").groupBy("word", "tail").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, head: int, frequent: int) -> tuple[Vocabulary, DataFrame, np.ndarray]:
    """The vocabulary, the rare words' counts, and the counts of head words followed by tail classes."""
    levels = counts.groupBy(F.least("c", F.lit(1_000_000)).alias("c")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    level, n = levels["c"].to_numpy(), levels["n"].to_numpy()
    order = np.argsort(-level)
    fits = np.cumsum(n[order]) <= frequent
    least = int(level[order][fits][-1]) if fits.any() else 1_000_001
    is_frequent = (F.col("c") >= least) | (F.col("word") == END)
    held = counts.filter(is_frequent).toArrow()  # at most ``frequent`` + 1 rows
    word, c, tail = held["word"].to_numpy().view(np.uint64), held["c"].to_numpy(), held["tail"].to_numpy()
    if not (word == END).any():
        word, c, tail = np.append(word, np.uint64(END)), np.append(c, 0), np.append(tail, 0)
    falling = np.lexsort((word, -c))
    top = falling[:head]
    if END not in word[top]:
        top = np.append(top[:head - 1], np.flatnonzero(word == END))
    per_tail = np.zeros((2, TAILS))
    for r in counts.groupBy("tail").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        per_tail[:, r["tail"]] = r["c"], r["n"]
    total, distinct = int(per_tail[0].sum()), int(per_tail[1].sum())
    per_tail -= np.stack([np.bincount(tail[top], c[top], TAILS), np.bincount(tail[top], c[top] > 0, TAILS)])
    ascending = np.argsort(word)
    place = np.full(len(word), -1, np.int32)
    place[top] = np.arange(len(top))
    found = Vocabulary(word[top], word[ascending], c[ascending], place[ascending], np.log10(per_tail[0] + SMOOTH * (per_tail[1] + 1)), total, distinct)
    return found, counts.filter(~is_frequent).select("word", "c"), np.concatenate([c[top], per_tail[0]])


def symbols(v: Vocabulary, found: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, places in ``known`` or -1)."""
    at = v.find(found)
    place = np.where(at >= 0, v.place[at], -1)
    return np.where(place >= 0, place, len(v.head) + tail).astype(np.int32), at


def with_end(symbol: np.ndarray, bounds: np.ndarray, end: int) -> list[np.ndarray]:
    return [np.append(symbol[s:e], np.int32(end)) for s, e in zip(bounds[:-1], bounds[1:])]


def trained(rows: DataFrame, v: Vocabulary, layout: gru.Layout, start: dict[str, np.ndarray], replicas: int, rate: float) -> dict[str, np.ndarray]:
    """One round: every replica trains from ``start`` on its rows; the average by tokens."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = gru.Trainer(start, layout, v.end, rate)
        for piece in slices(batches, "text", 6000, 12 << 20):
            found, tail, bounds = hashed(*text_bytes(piece.column(0)))
            trainer.train(with_end(symbols(v, found, tail)[0], bounds, v.end), LANES, STEPS, more=True)
        trainer.train([], LANES, STEPS)
        if trainer.tokens:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()]), pa.array([trainer.tokens]), pa.array([gru.pack(trainer.p)])], ["replica", "tokens", "weights"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for replica, tokens, weights in zip(*(c.to_pylist() for c in batch.columns)):
                group = total.setdefault(replica, [0, 0.0])
                group[0] += tokens
                group[1] = group[1] + np.frombuffer(weights, np.float32) * np.float64(tokens)
        for replica, (tokens, summed) in total.items():
            yield pa.record_batch([pa.array([replica]), pa.array([tokens]), pa.array([(summed / tokens).astype(np.float32).tobytes()])], ["replica", "tokens", "weights"])

    kind = "replica long, tokens long, weights binary"
    level = stored(rows.select("text").coalesce(replicas).mapInArrow(work, kind), "replicas")
    while replicas > 8:
        replicas = ceil(replicas / 8)
        merged = level.withColumn("replica", F.floor(F.col("replica") / 8)).repartition(replicas, "replica").sortWithinPartitions("replica")
        level = stored(merged.mapInArrow(average, kind), "replicas")
    got = level.collect()  # at most 8 rows
    tokens = sum(r["tokens"] for r in got)
    if not tokens:
        return start
    return gru.unpack(sum(np.frombuffer(bytes(r["weights"]), np.float32) * (r["tokens"] / tokens) for r in sorted(got, key=lambda r: r["replica"])).astype(np.float32).tobytes(), start)


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", head: int = HEAD, frequent: int = FREQUENT, hidden: int = HIDDEN,
        share: float = SHARE, rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """Learn from all rows; without any the model knows only the end of a text."""
    rows = docs.select(empty_text(text).alias("text"), F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_003)).alias("draw"))
    counts = stored(counted(rows), "counts")
    v, rare, class_counts = vocabulary(counts, head, frequent)
    layout = gru.equal_mass(class_counts[:len(v.head)], CLASSES, TAILS, joint=True)
    weights = gru.initial(layout, class_counts, np.add.reduceat(class_counts, layout.runs[:-1]), hidden, _SEED)
    replicas = max(1, round(v.total * share / rounds / REPLICA_TOKENS))
    for i in range(rounds):
        low, high = (int(1_000_003 * share * j / rounds) for j in (i, i + 1))
        weights = trained(rows.filter((F.col("draw") >= low) & (F.col("draw") < high)), v, layout, weights, replicas, rate / (i + 1))
    return Model(v, layout, weights, rare)


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, base_score, score (both log10).

    Null text counts as empty, which is the end token alone. Repeated rows and null ids are scored
    row by row; an empty table gives an empty result.
    """
    v, layout, weights = model.words, model.layout, model.weights
    kind = "row long, doc_id long, n_tokens long, n_known long, head_sum double, model_sum double, rare array<long>, times array<int>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        log_count = np.append(np.log10(v.counts + SMOOTH), 0)
        for piece in slices(batches, "text", 4000, 12 << 20):
            found, tail, bounds = hashed(*text_bytes(piece.column(1)))
            symbol, at = symbols(v, found, tail)
            owner = np.repeat(np.arange(piece.num_rows), np.diff(bounds))
            there = at >= 0
            end_place = int(np.searchsorted(v.known, np.uint64(END)))
            logs = log_count[at]  # 0 at the end, for words without a count here
            known = np.bincount(owner[there], minlength=piece.num_rows) + (v.counts[end_place] > 0)  # every word in the table but END was counted
            base = np.bincount(owner, logs, piece.num_rows) + log_count[end_place]
            in_tail = np.flatnonzero(symbol >= layout.head)
            inside = np.bincount(owner[in_tail], logs[in_tail] - v.tail_log[symbol[in_tail] - layout.head], piece.num_rows)
            neural = gru.log_chances(weights, layout, with_end(symbol, bounds, v.end), v.end) / log(10)
            # Words without a count here: distinct ones per document, for the join.
            far = np.flatnonzero(~there)
            order = np.lexsort((found[far], owner[far]))
            own, word = owner[far][order], found[far][order]
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (word[1:] != word[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(own))).astype(np.int32)
            cuts = pa.array(np.searchsorted(own[first], np.arange(piece.num_rows + 1)).astype(np.int32))
            yield pa.record_batch([
                pa.array(row + np.arange(piece.num_rows)), piece.column(0), pa.array(np.diff(bounds) + 1), pa.array(known.astype(np.int64)),
                pa.array(base), pa.array(neural + inside),
                pa.ListArray.from_arrays(cuts, pa.array(word[first].view(np.int64))), pa.ListArray.from_arrays(cuts, pa.array(times))],
                [c.split()[0] for c in kind.split(", ")])
            row += piece.num_rows

    found = stored(docs.select(F.col(key).cast("long").alias("doc_id"), empty_text(text).alias("text")).mapInArrow(work, kind), "scored")
    pairs = found.select("row", F.explode(F.arrays_zip("rare", "times")).alias("p")).select("row", F.col("p.rare").alias("word"), F.col("p.times").alias("times"))
    c = F.coalesce("c", F.lit(0))
    more = (pairs.join(model.rare, "word", "left").groupBy("row")
            .agg(F.sum(F.col("times") * F.log10(c + SMOOTH)).alias("more"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("also")))
    unit = float(np.log10(v.total + SMOOTH * (v.distinct + 1)))
    more_sum: Column = F.coalesce("more", F.lit(0.0))
    return (found.drop("rare", "times").join(more, "row", "left")
            .select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
                    (F.col("head_sum") + more_sum - F.col("n_tokens") * unit).alias("base_score"), (F.col("model_sum") + more_sum).alias("score")))


def op5_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 10) == 0
    found = score(docs, fit(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
