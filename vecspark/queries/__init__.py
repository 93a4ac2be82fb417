"""The registered queries: each a Spark callable, most with an equivalent DuckDB text."""

from __future__ import annotations

from vecspark.queries import (  # noqa: F401
    geo,
    hybrid,
    indexes,
    jsontables,
    mutation,
    partitions,
    reads,
    tables,
    text,
    vectors,
)
from vecspark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
