"""Registered queries with the SQL each is checked against.

Every query reads the given tables, or frames Spark derives from them.
"""

from curatrix.registry import columns, counting, joining, jobs, reading, texts  # noqa: F401
from curatrix.registry.base import ORACLE, QUERIES, Tables

__all__ = ["ORACLE", "QUERIES", "Tables"]
