"""All checked queries."""

from __future__ import annotations

from checks import file_queries, measure_queries, page_queries
from checks.measure_queries import Query


def all_queries() -> dict[str, Query]:
    """Query name: (Spark query, SQL that gives the same)."""
    return {
        **measure_queries.queries(),
        **file_queries.queries(),
        **page_queries.queries(),
    }
