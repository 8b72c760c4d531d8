"""Every registered query and its SQL, by name."""

from __future__ import annotations

from .plans import analysis, canonical, discovery, estate, history, planning, sheets, upkeep, workbook  # noqa: F401  (they register)
from .plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
