"""The registered queries."""

from tidemark.plans import batch, live, windows  # noqa: F401
from tidemark.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
