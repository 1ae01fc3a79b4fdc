"""Registered queries: name -> (Spark query, operators it covers, the same result as DuckDB SQL)."""

from __future__ import annotations

from cardloom.plans.catalog import coverage, joins, merging, pages, profiles, selection, sinks, texts  # noqa: F401
from cardloom.plans.catalog.base import CATALOG

__all__ = ["CATALOG"]
