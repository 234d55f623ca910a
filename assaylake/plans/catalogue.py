"""All registered queries."""

from __future__ import annotations

from assaylake.plans import aggregate_queries, assembly_queries, join_queries, picture_queries, record_queries, review_queries, rule_queries, scalar_queries, window_queries  # noqa: F401
from assaylake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
