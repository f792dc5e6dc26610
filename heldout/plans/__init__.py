"""Named queries over the driver's tables and their DuckDB oracle SQL."""

from heldout.plans.oracle import ORACLE_SQL
from heldout.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
