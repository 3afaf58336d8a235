"""Every query over the driver's tables, with the SQL that must agree with it."""

from __future__ import annotations

from waymark.plans import edges, entities, motion, upkeep  # noqa: F401  they register their queries
from waymark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
