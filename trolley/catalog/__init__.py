"""The registered queries, each with the SQL it is checked against where SQL can say it."""

from trolley.catalog import baskets, cleaning, features, frames, models, recommendations, samples, sources, texts, universes  # noqa: F401
from trolley.catalog.base import REGISTRY

__all__ = ["REGISTRY"]
