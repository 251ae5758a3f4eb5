"""Every operator as a query over the test tables, next to an equivalent SQL statement."""

from sprintmart.queries import marts, relational, scalars, sources  # noqa: F401
from sprintmart.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
