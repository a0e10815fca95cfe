"""All registered queries and their DuckDB counterparts."""

from __future__ import annotations

from nucleispark.plans import queries_boxes, queries_density, queries_files, queries_masks, queries_tiles  # noqa: F401
from nucleispark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
