"""Evaluation of scored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trolley.operators.ordering import running_sums

# Fixed value: clip of probabilities in the losses.
EPS = 1e-7


def auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact ROC-AUC with half credit for ties: count per score, then running sums."""
    groups = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    placed = running_sums(groups, [F.asc("s")], {"neg": "neg_below"})
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    return placed.agg((wins / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def clip(p: Column, eps: float = EPS) -> Column:
    return F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps))


def accuracy(label: str, prediction: str) -> Column:
    return F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0))


def mse(label: str, prediction: str) -> Column:
    return F.avg((F.col(label) - F.col(prediction)) * (F.col(label) - F.col(prediction)))


def r2(label: str, prediction: str) -> Column:
    error = F.sum((F.col(label) - F.col(prediction)) * (F.col(label) - F.col(prediction)))
    return 1.0 - error / (F.var_pop(label) * F.count(label))


def binary_cross_entropy(label: str, probability: str) -> Column:
    p = clip(F.col(probability))
    return F.avg(-(F.col(label) * F.log(p) + (1 - F.col(label)) * F.log(1 - p)))


def log_loss(label: str, probabilities: Sequence[str]) -> Column:
    """Multi-class log-loss; the label is the position of its probability column."""
    chosen = F.get(F.array(*[F.col(f"`{p}`") for p in probabilities]), F.col(label).cast("int"))
    return F.avg(-F.log(clip(chosen)))


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """Accuracy, R2, MSE and binary cross-entropy in one pass."""
    return df.agg(accuracy(label, prediction).alias("accuracy"), r2(label, probability).alias("r2"),
                  mse(label, probability).alias("mse"), binary_cross_entropy(label, probability).alias("bce"))


def focal_loss(df: DataFrame, label: str = "label", probability: str = "probability", gamma: float = 2.0) -> DataFrame:
    """Sum over rows of (1 - pt)^gamma * -ln(pt), pt the probability given to the true class."""
    p = clip(F.col(probability))
    pt = F.when(F.col(label) == 1, p).otherwise(1 - p)
    return df.agg(F.sum(F.pow(1 - pt, F.lit(gamma)) * -F.log(pt)).alias("focal_loss"))
