"""Every operator as a named query over the test tables, with the SQL that gives the same result."""

from __future__ import annotations

from khodat.checks.registry import ORACLES, QUERIES
from khodat.checks import columns, loads, rows, scalars, scans, writes  # noqa: F401  (they register queries)

__all__ = ["ORACLES", "QUERIES"]
