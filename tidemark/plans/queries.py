"""All registered queries."""

from tidemark.plans import item_queries, lake_queries, landing_queries, leadtime_queries  # noqa: F401
from tidemark.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
