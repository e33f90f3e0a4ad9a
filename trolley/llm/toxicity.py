"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the byte n-grams it holds (orders 4 to 7, presence only, hashed, A-Z in
lower case). Over the labelled sample, feature f gets the ratio r_f of its smoothed frequencies in
toxic and other texts; the features with the largest weighted ratios are selected, and logistic
regression is fitted on r_f times presence. Presence and a small set of selected features keep the
score of a very long text as calm as that of a short one.

Scale: the classifier is fitted on a bounded sample of labelled rows (``per_class`` of each label,
those with the smallest hash of the id). Counting is a Spark aggregation; the fit sees only the
selected features of the sample, in one task. Scoring is one pass of Arrow batches over all texts,
without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from trolley.llm.common import empty_text, id_bucket, slices, stored, table, text_bytes
from trolley.llm.ngrams import FOLD, ngram_hashes

ORDERS, BITS = (4, 5, 6, 7), 18
PER_CLASS, SELECTED, LEAST_TEXTS = 3_000, 8_192, 4
THRESHOLD = 0.7
SLICE = 1 << 18  # bytes of text whose n-grams are made in one go (a longer text is one slice)
_SIZE = len(ORDERS) << BITS


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # per feature, zero where not selected
    bias: float

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        where, docs = present(data, ends, self.weights != 0)
        z = self.bias + np.bincount(docs, self.weights[where], len(ends) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def present(data: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, document numbers): each wanted feature once per document that holds it."""
    n_docs = max(len(ends) - 1, 1)
    kind = np.uint32 if n_docs << BITS <= 1 << 32 else np.int64
    features, owners, folded = [], [], FOLD[data]
    for i, order in enumerate(ORDERS):  # one order at a time: the n-grams of a text take many times its bytes
        bins, docs = ngram_hashes(folded, ends, (order,), BITS)[order]
        hit = np.flatnonzero(wanted[i << BITS:(i + 1) << BITS][bins])
        keys = np.unique(docs[hit].astype(kind) << kind(BITS) | bins[hit].astype(kind))
        features.append((keys & kind((1 << BITS) - 1)).astype(np.int32) + np.int32(i << BITS))
        owners.append((keys >> kind(BITS)).astype(np.int32))
    return np.concatenate(features), np.concatenate(owners)


def sample(docs: DataFrame, labels: DataFrame, label: str, text: str, key: str, per_class: int) -> tuple[DataFrame, int, int]:
    """The stored sample (doc_id, text, label), and how many labelled rows of each class there are."""
    known = (labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
             .groupBy(F.col(key).cast("long").alias("doc_id")).agg((F.max(label) > 0).cast("int").alias("label")))
    known = stored(known, "labels")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = [known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = stored(draw[0].unionByName(draw[1]), "chosen")  # at most 2 * per_class rows
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), empty_text(text).alias("text"))
    return stored(rows.join(F.broadcast(chosen), "doc_id").coalesce(8), "sample"), counts.get(0, 0), counts.get(1, 0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id",
        per_class: int = PER_CLASS, selected: int = SELECTED) -> Model:
    """Without labelled texts of both classes the score is the smoothed share of the label."""
    rows, others, toxic = sample(docs, labels, label, text, key, per_class)
    prior = log((toxic + 0.5) / (others + 0.5))
    if not others or not toxic:
        return Model(np.zeros(_SIZE, np.float32), prior)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, _SIZE), np.int64)
        for piece in slices(batches, "text", 500, SLICE):
            where, own = present(*text_bytes(piece.column(1)), np.ones(_SIZE, bool))
            kinds = piece.column(2).to_numpy()
            for c in (0, 1):
                n[c] += np.bincount(where[kinds[own] == c], minlength=_SIZE)
        seen = np.flatnonzero(n.sum(0))
        for at in range(0, len(seen), 50_000):
            part = seen[at:at + 50_000]
            yield pa.record_batch([pa.array(part), pa.array(n[0][part]), pa.array(n[1][part])], ["f", "q", "p"])

    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total_p, total_q = sizes.get(1, 0) + 1, sizes.get(0, 0) + 1
    counts = rows.mapInArrow(count, "f long, q long, p long").groupBy("f").agg(F.sum("q").alias("q"), F.sum("p").alias("p"))
    ratio = F.log((F.col("p") + 0.5) / total_p) - F.log((F.col("q") + 0.5) / total_q)
    best = (counts.filter(F.col("p") + F.col("q") >= LEAST_TEXTS).withColumn("r", ratio)
            .orderBy((F.abs("r") * (F.col("p") + F.col("q"))).desc(), "f").limit(selected).select("f", "r").collect())
    ratios = np.zeros(_SIZE, np.float32)
    for f, r in best:
        ratios[f] = r or 1e-6
    # Classes are drawn evenly; the intercept goes back to their real shares.
    shift = prior - log((sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5))

    def regress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = []
        for piece in slices(batches, "text", 500, SLICE):
            where, own = present(*text_bytes(piece.column(1)), ratios != 0)
            order = np.argsort(own, kind="stable")
            where, cuts = where[order], np.searchsorted(own[order], np.arange(piece.num_rows + 1))
            texts += [(i, y, where[s:e]) for i, y, s, e in zip(piece.column(0).to_pylist(), piece.column(2).to_pylist(), cuts[:-1], cuts[1:])]
        texts.sort(key=lambda t: t[0])
        slot = np.flatnonzero(ratios)
        y = np.array([t[1] for t in texts], float)
        row = np.repeat(np.arange(len(texts)), [len(t[2]) for t in texts])
        col = np.searchsorted(slot, np.concatenate([t[2] for t in texts])) if texts else np.zeros(0, int)
        w, b = logistic(row, col, ratios[slot].astype(float), y)
        out = np.zeros(_SIZE, np.float32)
        out[slot] = w * ratios[slot]
        yield pa.record_batch([pa.array([out.tobytes()]), pa.array([b])], ["weights", "bias"])

    fitted = rows.coalesce(1).mapInArrow(regress, "weights binary, bias double").first()
    return Model(np.frombuffer(bytes(fitted["weights"]), np.float32), fitted["bias"] + shift)


def logistic(row: np.ndarray, col: np.ndarray, scale: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights and intercept of penalised logistic regression on x[row, col] = scale[col], by Adam."""
    w, b, n = np.zeros(len(scale)), 0.0, max(len(y), 1)
    m, v, rate = np.zeros(len(scale) + 1), np.zeros(len(scale) + 1), 0.05
    for t in range(1, steps + 1):
        z = b + np.bincount(row, (w * scale)[col], len(y))
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        slope = np.append(np.bincount(col, error[row], len(scale)) * scale / n + penalty * w, error.sum() / n)
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, score, predicted. Null text counts as empty, whose score is the
    model's intercept; an empty table gives an empty result."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", 2000, SLICE):
            found = model.scores(*text_bytes(piece.column(1)))
            yield pa.record_batch([piece.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), empty_text(text).alias("text")).mapInArrow(work, "doc_id long, score double, predicted int")


def clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns. Every row is judged by
    its own text where it stands, so null and repeated ids need no rule."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, text, 2000, SLICE):
            found = model.scores(*text_bytes(piece.column(piece.schema.get_field_index(text))))
            yield piece.filter(pa.array(found < threshold))

    return docs.mapInArrow(work, docs.schema)


def learned(spark: SparkSession, sf_dir: str, docs: DataFrame) -> Model:
    labels = table(spark, sf_dir, "labels")
    return fit(docs, labels.filter(id_bucket(F.col("doc_id"), 3) != 1))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = score(docs, learned(spark, sf_dir, docs))
    return found.select("doc_id", (id_bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")
