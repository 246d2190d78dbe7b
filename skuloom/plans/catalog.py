"""All registered queries and oracles."""

from __future__ import annotations

from skuloom.plans import composites, primitives  # noqa: F401  (they register on import)
from skuloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
