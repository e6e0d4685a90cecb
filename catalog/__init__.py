"""Queries over the test tables, one per operator, each with an independent SQL statement of its result."""

from catalog import analysis_queries, ingest_queries, job_queries, serving_queries  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
