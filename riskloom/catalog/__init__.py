"""All registered queries. Importing a query module registers its entries."""

from riskloom.catalog import (
    evaluation_queries,
    mart_queries,
    model_queries,
    quality_queries,
    statistics_queries,
)
from riskloom.catalog.registry import ENTRIES

__all__ = ["ENTRIES", "evaluation_queries", "mart_queries", "model_queries", "quality_queries", "statistics_queries"]
