"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from ledgerflow.queries.registry import ORACLES, QUERIES
from ledgerflow.queries import basics, conversion, files, joins, jobs, protection  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
