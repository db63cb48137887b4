"""Registered queries over the test tables, each with the SQL that states its expected result."""

from __future__ import annotations

from tierflow.catalog.registry import ORACLES, QUERIES
from tierflow.catalog import banking, cleansing, hospital, ingest, social, star, tables, trips, whole_runs  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
