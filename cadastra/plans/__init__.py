"""Queries of the library."""

from . import audit_queries, boundary_queries, city_queries, clusters, comparison_queries, enrich_queries, evidence_queries, export_queries, facade_queries, heights, ledger_queries, relational, report_queries, run_queries, scalar_queries, tile_queries  # noqa: F401  (they register themselves)
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
