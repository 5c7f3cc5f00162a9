"""The registered queries and the SQL that checks them."""

from catalog import source_queries  # noqa: F401  isort: skip
from catalog import family_queries  # noqa: F401  isort: skip
from catalog import aggregate_queries  # noqa: F401  isort: skip
from catalog import graph_queries  # noqa: F401  isort: skip
from catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
