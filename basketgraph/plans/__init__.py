"""Query plans over the parquet tables, one registered builder per inventory item.

Importing this package registers every query in ``registry.REGISTRY``.
"""

from basketgraph.plans import (  # noqa: F401
    assign_queries,
    file_queries,
    graph_queries,
    order_queries,
    price_queries,
    stream_queries,
    text_queries,
)
from basketgraph.plans.registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
