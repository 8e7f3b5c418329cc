"""Registered queries: inputs derived from the given tables, wired to the jobs."""

from tagloom.plans import (  # noqa: F401
    audience_queries, fact_queries, lifecycle_queries, tag_queries, warehouse_queries,
)
from tagloom.plans.registry import REGISTRY, run

__all__ = ["REGISTRY", "run"]
