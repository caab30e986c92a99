"""Registered queries: each operator on the given tables, with the same question in SQL."""

from fixture_queries.base import ORACLE, QUERIES
from fixture_queries import (  # noqa: F401
    assets, catalogs, extraction, feeds, ledgers, lists, outcomes, records, runs, texts, variant_trees,
)

__all__ = ["ORACLE", "QUERIES"]
