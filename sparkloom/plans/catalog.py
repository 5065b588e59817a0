"""All registered queries; importing the modules registers them."""

from sparkloom.plans import (  # noqa: F401
    cluster_queries,
    graph_queries,
    missing_queries,
    privacy_queries,
    source_queries,
    tables,
)
from sparkloom.plans.registry import QUERIES

__all__ = ["QUERIES"]
