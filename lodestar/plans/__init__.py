"""Registered queries: each binds an operator to the given tables, most with equivalent SQL."""

from . import rating_queries, catalog_queries, nested_queries, recommend_queries, review_queries, vector_queries  # noqa: F401, I001
from .registry import REGISTRY

__all__ = ["REGISTRY"]
