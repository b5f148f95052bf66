"""Named query plans and their DuckDB oracles."""

from .catalog import QUERIES
from .oracle_sql import ORACLES

__all__ = ["QUERIES", "ORACLES"]
