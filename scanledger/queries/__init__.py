"""Queries over the shared test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from scanledger.queries import (  # noqa: F401  (importing registers)
    audits,
    axis,
    comparisons,
    grids,
    references,
    routes,
    scalars,
)
from scanledger.queries.registry import oracles, queries

__all__ = ["oracles", "queries"]
