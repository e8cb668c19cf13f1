"""Named queries over the test tables, each with the SQL it must agree with."""

from sediment.queries import edges, increments, recovery
from sediment.queries.oracle import ORACLE as _ORACLE
from sediment.queries.registry import QUERIES

ORACLE = _ORACLE | edges.ORACLE | increments.ORACLE | recovery.ORACLE

__all__ = ["ORACLE", "QUERIES"]
