"""Queries that bind the operators to the test tables, with their SQL."""

from __future__ import annotations

from loomseq.plans import aggregate_queries, coordinate_queries, core, deep_queries, join_queries, qc_queries, scoring_queries, sequence_queries, source_queries, stage_queries  # noqa: F401
from loomseq.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
