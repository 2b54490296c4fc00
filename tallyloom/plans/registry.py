"""All queries over the driver's tables, and the SQL that each is held against."""

from __future__ import annotations

from tallyloom.plans import marts, models, relational, scalars  # noqa: F401  they register their queries
from tallyloom.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
