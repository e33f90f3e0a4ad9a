"""One stored artefact for everything a model's inputs were fitted with."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from trolley.operators.text import MAX_STEPS, fit_vocab, padding_length, to_padded_ids
from trolley.session import materialise

VERSION = 1


@dataclass(frozen=True)
class FeatureConfig:
    """Token dictionaries and padding lengths of text columns, numeric columns with their training range,
    and the column order of the result."""

    vocabularies: Mapping[str, DataFrame]
    lengths: Mapping[str, int]
    ranges: Mapping[str, tuple[float, float]]

    @property
    def columns(self) -> list[str]:
        return [*self.lengths, *self.ranges]

    def apply(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Keys, padded token ids of each text column, and numeric columns scaled by the training range
        (values outside it leave [0, 1]; a constant column is 0). Rows are told apart by their keys."""
        scaled = []
        for c, (low, high) in self.ranges.items():
            scaled.append(((F.col(f"`{c}`").cast("double") - low) / ((high - low) or 1.0)).alias(c))
        out = df.select(*keys, *scaled)
        for c, vocabulary in self.vocabularies.items():
            ids = to_padded_ids(df, keys, c, vocabulary, self.lengths[c]).withColumnRenamed("ids", c)
            out = out.join(ids, list(keys))
        return out.select(*keys, *[F.col(f"`{c}`") for c in self.columns])

    def save(self, spark: SparkSession, path: str) -> None:
        """Dictionaries as tables, everything else as one row of JSON; the row is written last, so a
        folder without it is not a configuration."""
        for i, c in enumerate(self.vocabularies):
            self.vocabularies[c].write.mode("overwrite").parquet(f"{path}/vocabulary-{i}")
        head = {"version": VERSION, "texts": list(self.vocabularies), "lengths": dict(self.lengths), "ranges": {c: list(r) for c, r in self.ranges.items()}}
        spark.createDataFrame([(json.dumps(head),)], "config string").coalesce(1).write.mode("overwrite").parquet(f"{path}/config")


def fit_config(df: DataFrame, texts: Sequence[str], numeric: Sequence[str], limit: int = MAX_STEPS) -> FeatureConfig:
    vocabularies = {c: materialise(fit_vocab(df, c), "vocabulary") for c in texts}
    lengths = {c: padding_length(df, c, limit) for c in texts}
    ranges = {}
    if numeric:
        row = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{f.__name__}{i}") for i, c in enumerate(numeric) for f in (F.min, F.max)]).first()
        ranges = {c: (row[f"min{i}"] or 0.0, row[f"max{i}"] or 0.0) for i, c in enumerate(numeric)}
    return FeatureConfig(vocabularies, lengths, ranges)


def load_config(spark: SparkSession, path: str) -> FeatureConfig:
    head = json.loads(spark.read.parquet(f"{path}/config").first()["config"])
    if head["version"] != VERSION:
        raise ValueError(f"{path} holds version {head['version']} of the configuration, this library reads {VERSION}")
    vocabularies = {c: spark.read.parquet(f"{path}/vocabulary-{i}") for i, c in enumerate(head["texts"])}
    return FeatureConfig(vocabularies, head["lengths"], {c: tuple(r) for c, r in head["ranges"].items()})
