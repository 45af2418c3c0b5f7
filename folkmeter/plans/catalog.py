"""All registered queries."""

from folkmeter.plans import (  # noqa: F401
    queries_layers,
    queries_merge,
    queries_models,
    queries_statistics,
    queries_texts,
)
from folkmeter.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
