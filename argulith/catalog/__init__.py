"""Every operator as a query over the given tables, with the SQL it is checked against."""

from argulith.catalog import io, jobs, predictions, tables, texts, vectors  # noqa: F401  (they register themselves)
from argulith.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
