"""Registered queries over a loan-shaped view of the given tables, each with its SQL twin."""

from riskbook.catalog import (  # noqa: F401  (importing a module registers its queries)
    cleaning_queries,
    distribution_queries,
    evaluation_queries,
    exploration_queries,
    feature_queries,
    model_queries,
    source_queries,
)
from riskbook.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
