"""Queries over the given tables, each with the SQL that states its result.

The modules register into one table; importing this package loads them all.
"""

from lakeops.catalog import changes, learning, marts, relational, sources, streams, windows  # noqa: F401
from lakeops.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
