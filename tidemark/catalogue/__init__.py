"""Queries over the given tables that show every operator, each beside its SQL."""

from tidemark.catalogue import backfill_queries, feed_queries, load_queries, value_queries  # noqa: F401
from tidemark.catalogue.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
