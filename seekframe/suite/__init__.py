"""The registered queries: one per operator, each with the SQL it must equal."""

from seekframe.suite import changes, evidence, filters, fulltext, indexing, matching, paging, projection, relevance, scans
from seekframe.suite.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "changes",
    "evidence",
    "filters",
    "fulltext",
    "indexing",
    "matching",
    "paging",
    "projection",
    "relevance",
    "scans",
]
