"""All queries over the driver's tables."""

from __future__ import annotations

from . import enrichment, layout, more, text  # noqa: F401  they register
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
