"""All registered analyses."""

from __future__ import annotations

from strutwise.plans import queries_graph, queries_profile, queries_refine, queries_review, queries_sources, queries_volume
from strutwise.plans.catalog import ORACLE_SQL, QUERIES

FLAGSHIP = "otsu_threshold"
MODULES = (queries_graph, queries_profile, queries_refine, queries_review, queries_sources, queries_volume)

__all__ = ["FLAGSHIP", "MODULES", "ORACLE_SQL", "QUERIES"]
