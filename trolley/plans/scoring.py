"""From scored customers to the delivered prediction table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from trolley.operators.filters import missing_from, restrict_to
from trolley.operators.recommend import blend
from trolley.operators.summary import base_rates

# Override scores of the three items pushed for customers without history.
COLD_START_SCORES = (1.0, 0.9, 0.8)

# Blend weights in use.
BLENDS = {"three": (0.4, 0.2, 0.4), "families": (0.25, 0.25, 0.25, 0.25), "networks": (0.3, 0.3, 0.4)}


def cold_start(scored: DataFrame, template: DataFrame, training: DataFrame, targets: Sequence[str],
               overrides: Mapping[str, float] | None = None, key: str = "customer_id") -> DataFrame:
    """Template customers in order: scored ones as they are, the others with the targets' base
    rates, except for the overridden targets."""
    rates = base_rates(training, targets).first().asDict()  # one row
    rates.update(overrides or {})
    missing = missing_from(template, scored, [key]).select(key, *[F.lit(float(rates[t])).alias(t) for t in targets])
    known = restrict_to(scored, template, [key]).select(key, *[F.col(f"`{t}`") for t in targets])
    return known.unionByName(missing).orderBy(key)


def family_blend(families: Sequence[DataFrame], targets: Sequence[str], key: str = "customer_id") -> DataFrame:
    """Equal-weight blend of the feature-family models."""
    share = 1.0 / len(families)
    return blend(families, [share] * len(families), [key], targets).orderBy(key)
