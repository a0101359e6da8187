"""All registered queries."""

from votealloc.plans import allocation_queries, key_queries, method_queries, report_queries, source_queries  # noqa: F401
from votealloc.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
