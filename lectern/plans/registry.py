"""All registered queries and their check SQL."""

from lectern.plans import (  # noqa: F401
    catalog_queries,
    chain_queries,
    content_queries,
    graph_queries,
    matching_queries,
    personal_queries,
    popularity_queries,
    source_queries,
    vector_queries,
)
from lectern.plans.inputs import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
