"""Registered queries on the star schema, each next to the SQL that states its result."""

from catalog import measures, operators, reports, slices, storage
from catalog.registry import QUERIES

__all__ = ["all_names", "measures", "operators", "reports", "slices", "storage"]


def all_names() -> list[str]:
    return list(QUERIES)
