"""All registered queries (importing the groups fills the registry)."""

from pagelake.plans import q_audit, q_feed, q_flows, q_pages, q_requests, q_seeds, q_stream  # noqa: F401
from pagelake.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
