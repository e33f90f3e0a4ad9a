"""Sparse feature rows: text, categorical and numeric blocks side by side, and linear models on them.

A row's entries are gathered per key into two arrays, ``indices`` and ``values``; nothing is as wide as
the vocabulary except a model's own weights. Fits read the rows once per step: tasks add up their part
of the gradient, blocks of it are summed by a shuffle, and the driver holds vectors of the model's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from trolley.operators.ordering import number_rows
from trolley.session import materialise, scratch_path

SLOTS = 1 << 14  # numbers of a gradient that travel as one row
NEWTON = 64  # features up to which a logistic fit adds up second derivatives


@dataclass(frozen=True)
class Block:
    """Long weights (key columns, ``term``, ``weight``) and the numbering (``term``, ``index`` from 0) of
    their vocabulary. Terms outside the numbering are left out."""

    weights: DataFrame
    index: DataFrame
    size: int


def block(weights: DataFrame, vocabulary: DataFrame | None = None) -> Block:
    """Number a vocabulary (by default the weights' own terms) in term order."""
    terms = (weights if vocabulary is None else vocabulary).select("term").distinct()
    index = materialise(number_rows(terms, [F.asc("term")], "index", 0), "terms")
    return Block(weights, index, index.count())


def column_kinds(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(categorical, numeric) columns by their type: strings and booleans, and numbers."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    return ([f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BooleanType))],
            [f.name for f in fields if isinstance(f.dataType, T.NumericType)])


def categories(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One-hot entries of the columns as weights: term ``<column>=<value>``; NULL has no entry."""
    cells = F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.concat(F.lit(f"{c}="), F.col(f"`{c}`").cast("string"))) for c in columns])
    return df.select(*key, F.explode(F.filter(cells, lambda t: t.isNotNull())).alias("term")).withColumn("weight", F.lit(1.0))


def assemble_sparse(base: DataFrame, key: Sequence[str], blocks: Sequence[Block], numeric: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """(base rows with ``indices`` and ``values``, number of features): the blocks one after the other,
    then the numeric columns; missing entries are 0. The base's key is unique and not NULL."""
    start, parts = 0, []
    for b in blocks:
        parts.append(b.weights.join(b.index, "term").select(*key, (F.col("index") + start).alias("index"), F.col("weight").alias("value")))
        start += b.size
    if numeric:
        cells = F.array(*[F.struct(F.lit(start + i).cast("long").alias("index"), F.col(f"`{c}`").cast("double").alias("value")) for i, c in enumerate(numeric)])
        parts.append(base.select(*key, F.explode(cells).alias("_c")).select(*key, "_c.index", "_c.value"))
    entries = reduce(DataFrame.unionByName, parts).filter("value <> 0")
    packed = entries.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col("index").cast("int").alias("i"), F.col("value").cast("double").alias("v")))).alias("_e"))
    rows = base.join(packed, list(key), "left").withColumns({
        "indices": F.coalesce(F.col("_e.i"), F.array().cast("array<int>")), "values": F.coalesce(F.col("_e.v"), F.array().cast("array<double>"))})
    return rows.drop("_e"), start + len(numeric)


def as_vectors(rows: DataFrame, size: int, out: str = "features") -> DataFrame:
    """``indices`` and ``values`` as one sparse vector column, for estimators that want it.

    The parts are written as plain columns and read back under the vector's own type: no Python runs.
    """
    kept = rows.drop("indices", "values")
    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), "indices", "values").alias(out)
    path = scratch_path(rows.sparkSession, "vectors")
    rows.select(*[F.col(f"`{c}`") for c in kept.columns], vector).write.parquet(path)
    return rows.sparkSession.read.schema(T.StructType([*kept.schema.fields, T.StructField(out, VectorUDT())])).parquet(path)


def from_vectors(df: DataFrame, features: str = "features") -> DataFrame:
    """A vector column as ``indices`` and ``values``; all entries are kept."""
    values = vector_to_array(F.col(features))
    return df.withColumns({"values": values, "indices": F.sequence(F.lit(0), F.size(values) - 1)}).drop(features)


def without_zeros(rows: DataFrame) -> DataFrame:
    """The rows without entries of value 0, which add nothing to any product; their number of features stays."""
    entries = F.filter(F.arrays_zip("indices", "values"), lambda e: e["values"] != 0)
    return rows.withColumn("_e", entries).withColumns({"indices": F.col("_e.indices"), "values": F.col("_e.values")}).drop("_e")


def only(rows: DataFrame, places: Sequence[int], size: int) -> DataFrame:
    """The rows with their entries at ``places`` (of ``size`` features) alone, renumbered by their order in the list."""
    numbers = [-1] * size
    for i, place in enumerate(places):
        numbers[place] = i
    number = F.array(*map(F.lit, numbers))
    entries = F.filter(F.transform(F.arrays_zip("indices", "values"), lambda e: F.struct(F.get(number, e["indices"]).alias("i"), e["values"].alias("v"))), lambda e: e["i"] >= 0)
    return rows.withColumn("_e", entries).withColumns({"indices": F.col("_e.i"), "values": F.col("_e.v")}).drop("_e")


Step = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def summed(rows: DataFrame, labels: Sequence[str], step: Step, length: int) -> np.ndarray:
    """Sum of ``step(row numbers, indices, values, labels)`` over all rows, in one scan.

    ``step`` gets the entries of a batch and its label columns and returns ``length`` numbers. Tasks send
    blocks of SLOTS numbers that are not all zero; if there is more than one, each is added up by one task.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            ends = batch.column(0).offsets.to_numpy().astype(np.int64)
            indices = batch.column(0).values.to_numpy()[ends[0]:ends[-1]]
            values = batch.column(1).values.to_numpy()[ends[0]:ends[-1]]
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, batch.num_columns)]
            total += step(np.repeat(np.arange(batch.num_rows), np.diff(ends)), indices, values, np.stack(columns, 1))
        for at in range(0, length, SLOTS):
            part = total[at:at + SLOTS]
            if part.any():
                yield pa.record_batch([pa.array([at]), pa.array([part.tobytes()])], ["at", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.frombuffer(part)
                sums[at] = sums[at] + found if at in sums else found
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.array([s.tobytes() for s in sums.values()])], ["at", "part"])

    parts = rows.select("indices", "values", *[F.col(f"`{c}`").cast("double") for c in labels]).mapInArrow(work, "at long, part binary")
    if length > SLOTS:
        parts = parts.repartition("at").mapInArrow(add, "at long, part binary")
    out = np.zeros(length)
    for at, part in parts.collect():  # a row per partition, or per block
        out[at:at + SLOTS] += np.frombuffer(bytes(part))
    return out


@dataclass(frozen=True)
class Linear:
    """Weights (features x targets), intercepts, and the scans the fit took."""

    weights: np.ndarray
    intercepts: np.ndarray
    scans: int

    def predict(self, rows: DataFrame, names: Sequence[str], logistic: bool = False) -> DataFrame:
        """The rows without their entries, with one score (a probability, if ``logistic``) per target."""
        weights, intercepts = self.weights, self.intercepts

        @F.pandas_udf("array<double>")
        def scores(indices: pd.Series, values: pd.Series) -> pd.Series:
            sizes = indices.map(len).to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            at, value = (np.concatenate([*x.to_numpy(), []]) for x in (indices, values))
            out = np.stack([np.bincount(row, value * w[at.astype(int)], len(sizes)) for w in weights.T], 1) + intercepts
            return pd.Series(list(1 / (1 + np.exp(-np.clip(out, -500, 500))) if logistic else out))

        kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("indices", "values")]
        scored = rows.select(*kept, scores("indices", "values").alias("_s"))
        return scored.select(*kept, *[F.col("_s")[i].alias(n) for i, n in enumerate(names)])


def ridge(rows: DataFrame, labels: Sequence[str], size: int, alpha: float = 1.0, tolerance: float = 1e-12, most: int = 2_000) -> Linear:
    """Least squares with penalty alpha |w|^2 and a free intercept, for any number of features.

    Conjugate gradients on the centred normal equations, preconditioned by their diagonal: a step is one
    scan that adds up X'(Xv) for all labels at once. No features x features matrix exists.
    """
    many = len(labels)

    def moments(row, at, value, y):
        xy = [np.bincount(at, value * y[row, t], size) for t in range(many)]
        return np.concatenate([np.bincount(at, value, size), np.bincount(at, value * value, size), *xy, y.sum(0), [len(y)]])

    found = summed(rows, labels, moments, (2 + many) * size + many + 1)
    n = max(found[-1], 1.0)
    mean_x, mean_y = found[:size] / n, found[-1 - many:-1] / n
    goal = found[2 * size:(2 + many) * size].reshape(many, size).T - n * np.outer(mean_x, mean_y)
    diagonal = np.maximum(found[size:2 * size] - n * mean_x**2, 0)[:, None] + alpha

    def times(v: np.ndarray) -> np.ndarray:
        def product(row, at, value, y):
            out = []
            for t in range(many):
                score = np.bincount(row, value * v[at, t], len(y))
                out.append(np.bincount(at, value * score[row], size))
            return np.concatenate(out)
        return summed(rows, labels, product, many * size).reshape(many, size).T - n * np.outer(mean_x, mean_x @ v) + alpha * v

    w, r, scans = np.zeros((size, many)), goal.copy(), 1
    z = r / diagonal
    p, rz, scale = z.copy(), (r * z).sum(0), np.maximum(np.abs(goal).max(0, initial=0), 1e-300)
    while (np.abs(r).max(0, initial=0) > tolerance * scale).any() and scans < most:
        ap = times(p)
        scans += 1
        curve = (p * ap).sum(0)
        step = np.where(curve > 0, rz / np.where(curve > 0, curve, 1), 0)
        w, r = w + step * p, r - step * ap
        z = r / diagonal
        rz, before = (r * z).sum(0), rz
        p = z + np.where(before > 0, rz / np.where(before > 0, before, 1), 0) * p
    return Linear(w, mean_y - mean_x @ w, scans)


class _Descent:
    """One target's limited-memory quasi-Newton descent; it asks for one trial point per scan."""

    def __init__(self, start: np.ndarray, memory: int = 10):
        self.x, self.f, self.g, self.memory, self.pairs = start, np.inf, None, memory, []
        self.trial, self.done, self.step = start, False, 1.0

    def direction(self) -> np.ndarray:
        q, kept = self.g.copy(), []
        for s, y in reversed(self.pairs):
            a = s @ q / (y @ s)
            kept.append(a)
            q -= a * y
        if self.pairs:
            s, y = self.pairs[-1]
            q *= s @ y / (y @ y)
        for (s, y), a in zip(self.pairs, reversed(kept)):
            q += (a - y @ q / (y @ s)) * s
        return -q

    def told(self, f: float, g: np.ndarray, tolerance: float) -> None:
        if self.g is not None and not f <= self.f + 1e-4 * self.step * self.slope + 1e-12 * abs(self.f):
            self.step /= 2
            self.done = self.step < 1e-10
        else:
            if self.g is not None:
                s, y = self.trial - self.x, g - self.g
                if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
                    self.pairs = [*self.pairs, (s, y)][-self.memory:]
            self.x, self.f, self.g = self.trial, f, g
            self.done = np.abs(g).max() <= tolerance
            self.d = self.direction()
            self.slope = self.g @ self.d
            self.step = 1.0 if self.pairs else min(1.0, 1 / max(np.linalg.norm(g), 1e-300))
        self.trial = self.x if self.done else self.x + self.step * self.d


def _newton(rows: DataFrame, labels: Sequence[str], size: int, c: float, tolerance: float, most: int) -> Linear | None:
    """The same fits by damped Newton steps, for few features: a scan adds up the gradients and the second
    derivatives of all open labels. None if a label's steps stall, as they do where it has no finite optimum."""
    wide, many = size + 1, len(labels)
    sums = summed(rows, labels, lambda row, at, value, y: np.append(y.sum(0), len(y)), many + 1)
    n = max(sums[-1], 1.0)
    rate = np.clip(sums[:-1] / n, 1e-9, 1 - 1e-9)
    trial = np.vstack([np.zeros((size, many)), np.log(rate / (1 - rate))])
    best, loss, step, scale = trial.copy(), np.full(many, np.inf), np.zeros_like(trial), np.ones(many)
    open_, scans, penalty = list(range(many)), 1, np.append(np.full(size, 1 / c), 0)
    while open_ and scans < most:
        points = trial[:, open_]

        def slopes(row, at, value, y, open_=open_, points=points):
            x = np.zeros((len(y), wide))
            np.add.at(x, (row, at), value)
            x[:, size] = 1
            z, out = x @ points, []
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            for i, t in enumerate(open_):
                bend = p[:, i] * (1 - p[:, i])
                out += [x.T @ (p[:, i] - y[:, t]), (x.T @ (x * bend[:, None])).ravel(), [(np.logaddexp(0, z[:, i]) - y[:, t] * z[:, i]).sum()]]
            return np.concatenate(out)

        found = summed(rows, labels, slopes, len(open_) * (wide + wide * wide + 1)).reshape(len(open_), -1)
        scans += 1
        for t, part in zip(list(open_), found):
            w = trial[:, t]
            f, g = part[-1] + w @ (penalty * w) / 2, part[:wide] + penalty * w
            if not f <= loss[t] + 1e-9 * abs(loss[t]):  # too far: half the way, from the best point
                scale[t] /= 2
                if scale[t] < 1e-6:
                    return None
                trial[:, t] = best[:, t] + scale[t] * step[:, t]
                continue
            best[:, t], loss[t], scale[t] = w, f, 1.0
            if np.abs(g).max() <= tolerance * n:
                open_.remove(t)
                continue
            step[:, t] = -np.linalg.lstsq(part[wide:-1].reshape(wide, wide) + np.diag(penalty), g, rcond=None)[0]
            trial[:, t] = w + step[:, t]
    return None if open_ else Linear(best[:-1], best[-1], scans)


def logistic(rows: DataFrame, labels: Sequence[str], size: int, c: float = 1.0, tolerance: float = 1e-7, most: int = 500) -> Linear:
    """L2 logistic regressions of all labels (0 or 1) at once: summed loss + |w|^2 / (2 C), free intercept.

    Every scan evaluates all labels' trial points and adds up their gradients, so ten labels take as
    many scans as the slowest one alone. ``tolerance`` is for the gradient's mean over the rows. Up to NEWTON
    features take Newton steps first, which need some ten scans.
    """
    if 0 < size <= NEWTON:
        found = _newton(rows, labels, size, c, tolerance, min(most, 50))
        if found is not None:
            return found
    many = len(labels)
    sums = summed(rows, labels, lambda row, at, value, y: np.append(y.sum(0), len(y)), many + 1)
    n = max(sums[-1], 1.0)
    rate = np.clip(sums[:-1] / n, 1e-9, 1 - 1e-9)
    descents, scans = [_Descent(np.append(np.zeros(size), np.log(p / (1 - p)))) for p in rate], 1
    while not all(d.done for d in descents) and scans < most:
        open_ = [t for t, d in enumerate(descents) if not d.done]
        points = np.stack([descents[t].trial for t in open_], 1)

        def slopes(row, at, value, y, open_=open_, points=points):
            out = []
            for i, t in enumerate(open_):
                z = np.bincount(row, value * points[at, i], len(y)) + points[-1, i]
                off = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[:, t]
                out.append(np.concatenate([np.bincount(at, value * off[row], size), [off.sum(), (np.logaddexp(0, z) - y[:, t] * z).sum()]]))
            return np.concatenate(out)

        found = summed(rows, labels, slopes, len(open_) * (size + 2)).reshape(len(open_), size + 2)
        scans += 1
        for t, part in zip(open_, found):
            w = descents[t].trial[:-1]
            descents[t].told(part[-1] + w @ w / (2 * c), part[:-1] + np.append(w / c, 0), tolerance * n)
    best = np.stack([d.x for d in descents], 1)
    return Linear(best[:-1], best[-1], scans)
