"""Named query plans over a directory of parquet tables, with oracle SQL.

Importing this package registers every query in ``registry.QUERIES`` and its
DuckDB counterpart (when one exists) in ``registry.ORACLE_SQL``.
"""

from . import flights, learning, networks, routing  # noqa: F401  (registers queries)
from .registry import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
