"""All registered queries and their SQL."""

from casequarry.plans import (  # noqa: F401
    evaluation_queries, exchange_queries, flow_queries, operations_queries, pii_queries, quality_queries, search_queries,
    text_queries)
from casequarry.plans.registry import ORACLE, QUERIES

FLAGSHIP = "hybrid_fusion_topk"

__all__ = ["FLAGSHIP", "ORACLE", "QUERIES"]
