"""Fitted feature frames: what a training universe looked like, replayed on other rows for scoring.

A training universe fixes the items of its columns, the vocabulary of its item lists and the order of
its columns. ``fit_*`` builds the training rows with their TF-IDF columns and returns that description
with them; ``score`` builds rows with the same columns as of the end of the data, one for each customer
of a template. The description is small: its vocabulary holds only the terms of the listed items.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from trolley.functions.dates import reference_date
from trolley.functions.text import tag
from trolley.operators.filters import only_items, restrict_to
from trolley.operators.rfm import CUSTOMER, PENALTY, WINDOWS_LONG
from trolley.operators.summary import popular_items
from trolley.operators.text import Tfidf, term_counts, tfidf_fit, tfidf_transform, tfidf_wide
from trolley.plans import universe as U
from trolley.session import materialise

TERM = "tfidf_"


@dataclass(frozen=True)
class Frame:
    """``kind`` of universe, its targets, the items of its columns, its look-back windows, the number of
    popular items its lists add, its feature columns in order, and its vocabulary (term, document
    frequency, idf) over so many documents."""

    kind: str
    targets: tuple[str, ...]
    items: tuple[str, ...]
    windows: tuple[int, ...]
    popular: int
    columns: tuple[str, ...]
    documents: int
    vocabulary: tuple[tuple[str, int, float], ...]

    @property
    def terms(self) -> list[str]:
        return [t for t, _, _ in self.vocabulary]

    def tfidf(self, spark: SparkSession) -> Tfidf:
        return Tfidf(spark.createDataFrame([*self.vocabulary], "term string, df long, idf double"), self.documents)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "frame string").coalesce(1).write.mode("overwrite").parquet(path)


def load_frame(spark: SparkSession, path: str) -> Frame:
    found = json.loads(spark.read.parquet(path).first()["frame"])
    found["vocabulary"] = tuple(map(tuple, found["vocabulary"]))
    return Frame(**{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})


def _with_terms(rows: DataFrame, items: DataFrame, model: Tfidf, terms: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows with one TF-IDF column per term, 0 for customers without listed items."""
    weights = tfidf_transform(model, term_counts(items, keys, "item"), keys)
    wide = tfidf_wide(weights, keys, terms, TERM)
    return rows.join(wide, list(keys), "left").na.fill(0.0, [f"{TERM}{t}" for t in terms])


def _fitted(universe: U.Universe, kind: str, targets: Sequence[str], items: Sequence[str], windows: Sequence[int], popular: int = 0) -> tuple[DataFrame, Frame]:
    keys = (U.ORIGIN, *CUSTOMER)
    documents = universe.labelled.count()
    model = tfidf_fit(term_counts(universe.items, keys, "item"), documents)
    vocabulary = sorted((r["term"], r["df"], r["idf"]) for r in model.vocabulary.collect())  # terms of the listed items
    terms = [t for t, _, _ in vocabulary]
    rows = _with_terms(universe.rows, universe.items, Tfidf(universe.rows.sparkSession.createDataFrame(vocabulary, "term string, df long, idf double"), documents), terms, keys)
    columns = [c for c in rows.columns if c not in keys and not c.startswith("Target_")]
    return rows, Frame(kind, tuple(targets), tuple(items), tuple(windows), popular, tuple(columns), documents, tuple(vocabulary))


def fit_rolling(raw: DataFrame, targets: Sequence[str], n: int = 6, step: int = 30, windows: Sequence[int] = WINDOWS_LONG) -> tuple[DataFrame, Frame]:
    """(training rows, frame) of the rolling universe."""
    return _fitted(U.universe_rolling(raw, targets, n, step, windows), "rolling", targets, targets, windows)


def fit_gaps(raw: DataFrame, targets: Sequence[str], n: int = 6, step: int = 30, popular: int = 30) -> tuple[DataFrame, Frame]:
    """(training rows, frame) of the gap universe; its columns' items are those of every universe."""
    universe = U.universe_gaps(raw, targets, n, step, popular)
    items = [c[len("DayDiffMean_"):] for c in universe.rows.columns if c.startswith("DayDiffMean_")]
    return _fitted(universe, "gaps", targets, items, (), popular)


def fit_last_visit(raw: DataFrame, targets: Sequence[str], n: int = 4, windows: Sequence[int] = WINDOWS_LONG) -> tuple[DataFrame, Frame]:
    """(training rows, frame) of the last-visit universe."""
    return _fitted(U.universe_last_visit(raw, targets, n, windows), "last_visit", targets, targets, windows)


def score(frame: Frame, raw: DataFrame, template: DataFrame) -> DataFrame:
    """The template's customers with the frame's columns, as of the end of ``raw``.

    A rolling frame is dated back from the last date of the table, a last-visit frame from each
    customer's newest target purchase. Customers without purchases get the penalty everywhere and no
    term; an item that only the new rows hold makes no column, one they lack gives the penalty.
    """
    listed = list(frame.targets)
    if frame.kind == "gaps":  # the lists follow the new rows' popularity, the columns do not
        listed = sorted({*listed, *(r["item_id"] for r in popular_items(raw, frame.popular).collect())})
    past = restrict_to(only_items(raw, sorted({*listed, *frame.items})), template)
    if frame.kind == "last_visit":
        past = past.join(past.groupBy(*CUSTOMER).agg(F.max("InvoiceDate").alias("rd")), list(CUSTOMER))
    past = materialise(past, "score-past")
    if frame.kind == "rolling":
        blocks = U.rolling_blocks(past, frame.items, frame.windows, CUSTOMER, reference_date(raw))
    elif frame.kind == "gaps":
        blocks = U.gap_blocks(past, frame.items, CUSTOMER)
    else:
        blocks = U.last_visit_blocks(past, frame.items, frame.windows, CUSTOMER)
    rows = U.assemble_customer(template.select(*CUSTOMER).distinct(), blocks, CUSTOMER).na.fill(PENALTY)
    bought = only_items(past, listed)
    tagged = bought.select(*CUSTOMER, (F.col("item_id") if frame.kind == "gaps" else tag("ITEM_", F.col("item_id"))).alias("item"))
    rows = _with_terms(rows, tagged, frame.tfidf(raw.sparkSession), frame.terms, CUSTOMER)
    return rows.select(*CUSTOMER, *[F.col(f"`{c}`") for c in frame.columns])
