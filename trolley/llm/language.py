"""Language identification by mixture inference.

A text is a mixture of languages: each of its byte n-grams is drawn from one language's n-gram
distribution. Expectation-maximisation estimates the proportions; the set of languages is the one
with the best penalised likelihood among the leading ones (one language, the two largest, ...),
each set being fitted again. The prediction is the largest proportion of the chosen set.

Scale: n-gram counts come from a bounded number of labelled texts per language, drawn by the hash
of the id, and are a Spark aggregation of (language, bin). Prediction is one pass of Arrow batches:
many texts go through each step of the iteration together, and nothing is shuffled.

``identified`` adds one more component, noise (letters by chance, and as many stretches without letters
as a language has): a text whose largest proportion is noise has no identifiable language. A language
known from fewer than ``LEAST_TEXTS`` texts is blended with noise, so little training data rejects little.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trolley.llm.common import empty_text, id_bucket, slices, stored, table, text_bytes
from trolley.llm.ngrams import LETTERS, ngram_hashes

ORDER, BITS = 3, 15
PER_LANGUAGE = 3_000    # expected number of labelled texts per language
ROUNDS, PENALTY = 8, 6.0  # overlapping n-grams repeat evidence, so a language costs more than half a log n
LEAST_SHARE = 0.02      # a smaller share in the full mixture is never part of a larger set
SLICE = 1 << 18         # bytes of text worked on in one go (a longer text is one slice)
UNKNOWN = "und"
LEAST_TEXTS = 100       # texts that make a language's counts count in full against noise


@dataclass(frozen=True)
class Model:
    languages: list[str]
    chance: np.ndarray  # bins x languages, float32
    texts: tuple[int, ...] = ()  # labelled texts of each language
    noise: bool = False  # whether the last language is noise, which has to win by the cost of a language

    def with_noise(self) -> Model:
        """The same languages and noise after them."""
        noise = np.full(len(self.chance), 1 / len(self.chance))
        blank = ngram_hashes(np.full(ORDER, 32, np.uint8), np.array([0, ORDER]), (ORDER,), BITS)[ORDER][0]
        noise[blank] = self.chance[blank].max()  # digits and signs speak neither for nor against a language
        trust = np.minimum(np.array(self.texts, float) / LEAST_TEXTS, 1)
        chance = np.column_stack([self.chance * trust + noise[:, None] * (1 - trust), noise])
        return Model([*self.languages, UNKNOWN], chance.astype(np.float32), self.texts, True)

    def mixtures(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Proportions of each document (zero outside its chosen set); equal ones without n-grams."""
        n_docs, n_lang = len(ends) - 1, len(self.languages)
        shares = np.full((n_docs, n_lang), 1 / max(n_lang, 1))
        bins, docs = ngram_hashes(LETTERS[data], ends, (ORDER,), BITS)[ORDER]
        if not len(bins) or n_lang < 2:
            return shares
        size = np.bincount(docs, minlength=n_docs)
        filled = np.flatnonzero(size)
        starts = (np.cumsum(size) - size)[filled]
        size = size[filled]
        chance = self.chance[bins]
        alone = np.add.reduceat(np.log(self.chance)[bins], starts, dtype=np.float64)
        every, best = self._em(chance, starts, size, np.ones((len(filled), n_lang), bool))
        cost = PENALTY * 0.5 * np.log(size + 1)
        if self.noise:
            alone[:, -1] -= cost
        top = alone.argmax(1)
        score = alone.max(1)
        chosen = np.zeros((len(filled), n_lang))
        chosen[np.arange(len(filled)), top] = 1
        # No set can gain more than the full mixture, so most texts stop at one language here.
        order = np.argsort(-every, 1, kind="stable")
        possible = (every >= LEAST_SHARE).sum(1)
        for k in range(2, n_lang + 1):
            left = np.flatnonzero((best - cost * (k - 1) > score) & (possible >= k))
            if not len(left):
                continue
            rows = np.concatenate([np.arange(s, s + n) for s, n in zip(starts[left], size[left])])
            allowed = np.zeros((len(left), n_lang), bool)
            np.put_along_axis(allowed, order[left, :k], True, 1)
            own, found = self._em(chance[rows], np.cumsum(size[left]) - size[left], size[left], allowed)
            better = found - cost[left] * (k - 1) > score[left]
            score[left[better]] = (found - cost[left] * (k - 1))[better]
            chosen[left[better]] = own[better]
        shares[filled] = chosen
        return shares

    def _em(self, chance: np.ndarray, starts: np.ndarray, size: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(proportions, log-likelihood) of each document over its allowed languages."""
        share = (allowed / allowed.sum(1, keepdims=True)).astype(np.float32)
        for _ in range(ROUNDS):
            joint = chance * np.repeat(share, size, 0)
            joint /= joint.sum(1, keepdims=True)
            share = (np.add.reduceat(joint, starts, dtype=np.float64) / size[:, None]).astype(np.float32)
        joint = np.einsum("ij,ij->i", chance, np.repeat(share, size, 0))
        return share.astype(float), np.add.reduceat(np.log(joint), starts, dtype=np.float64)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = PER_LANGUAGE,
        smooth: float = 0.1) -> Model:
    """Learn from the rows with a language and a text; none of them gives a model without languages."""
    spark = docs.sparkSession
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(key)).alias("draw"), empty_text(text).alias("text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    if not counts:
        return Model([], np.zeros((1 << BITS, 0), np.float32))
    share = spark.createDataFrame([(k, min(1.0, per_language / n)) for k, n in counts.items()], "lang string, share double")
    drawn = rows.join(F.broadcast(share), "lang").filter(F.pmod("draw", F.lit(1_000_003)) < F.col("share") * 1_000_003)
    drawn = stored(drawn.select("lang", "text").repartition(8), "languages")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for piece in slices(batches, "text", 500, SLICE):
            bins, own = ngram_hashes(LETTERS[(both := text_bytes(piece.column(1)))[0]], both[1], (ORDER,), BITS)[ORDER]
            names = np.array(piece.column(0).to_pylist(), object)
            for name in set(names):
                total.setdefault(name, np.zeros(1 << BITS, np.int64))
                total[name] += np.bincount(bins[(names == name)[own]], minlength=1 << BITS)
        for name, n in total.items():
            seen = np.flatnonzero(n)
            yield pa.record_batch([pa.array([name] * len(seen), pa.string()), pa.array(seen), pa.array(n[seen])], ["lang", "bin", "n"])

    found = drawn.mapInArrow(count, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(counts)
    table_ = np.full((1 << BITS, len(languages)), smooth)
    place = {name: i for i, name in enumerate(languages)}
    table_[found["bin"].to_numpy(), [place[x] for x in found["lang"].to_pylist()]] += found["n"].to_numpy()
    return Model(languages, (table_ / table_.sum(0)).astype(np.float32), tuple(counts[x] for x in languages))


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (its share, drawn towards equal shares in short
    texts), proportions of all languages. ``und`` with score 0 and no proportions if the text is
    null, has no letter, or nothing was learned."""
    names = model.languages

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 1000, SLICE):
            data, ends = text_bytes(piece.column(1))
            shares = model.mixtures(data, ends)
            known = piece.column(2).to_numpy(zero_copy_only=False) & bool(names)
            size = np.maximum(np.diff(ends) - ORDER + 1, 0)
            top = shares.argmax(1) if names else np.zeros(piece.num_rows, int)
            score = (shares.max(1) * size + 1) / (size + len(names)) if names else np.zeros(piece.num_rows)
            yield pa.record_batch([
                piece.column(0), pa.array([names[t] if k else UNKNOWN for t, k in zip(top, known)], pa.string()),
                pa.array(np.where(known, np.minimum(score, 1.0), 0.0)),
                pa.array([s.tolist() if k else [] for s, k in zip(shares, known)], pa.list_(pa.float64()))],
                ["doc_id", "lang_pred", "score", "proportions"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), empty_text(text).alias("text"), empty_text(text).rlike("\\p{L}").alias("letters"))
    return rows.mapInArrow(work, "doc_id long, lang_pred string, score double, proportions array<double>")


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language can be identified, with all their columns: null texts and texts
    without a letter go, also where nothing was learned, and so does a text that is noise rather than any
    learned language. Every row is judged by its own text where it stands, so null and repeated ids need
    no rule."""
    lettered = docs.filter(empty_text(text).rlike("\\p{L}"))
    if not model.languages:
        return lettered
    noisy = model.with_noise()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text, 1000, SLICE):
            shares = noisy.mixtures(*text_bytes(piece.column(piece.schema.get_field_index(text))))
            yield piece.filter(pa.array(shares.argmax(1) < len(noisy.languages) - 1))

    return lettered.mapInArrow(work, docs.schema)


def learned(docs: DataFrame) -> Model:
    return fit(docs.filter(id_bucket(F.col("doc_id"), 4) != 2))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, learned(docs))
    return found.select("doc_id", (id_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
