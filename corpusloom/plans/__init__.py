"""Registered queries and their oracle SQL."""

from corpusloom.plans import (  # noqa: F401  (importing registers the queries)
    q_aggregates,
    q_joins,
    q_maintenance,
    q_sampling,
    q_scalar,
    q_sources,
)
from corpusloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
