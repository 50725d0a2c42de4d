"""Named queries over the driver's tables, each with the SQL that must agree with it."""

from __future__ import annotations

from timelegs.registry.book import ORACLES, QUERIES
from timelegs.registry import models, reports, rows, serving, stops, xml  # noqa: F401  (fill the book)

__all__ = ["ORACLES", "QUERIES"]
