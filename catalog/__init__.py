"""Every operator as a query over the given tables, with the SQL that must agree."""

from catalog.registry import ORACLES, QUERIES
from catalog import devices, jobs, joins, models, reports, rules, sources, stats, storage, streams, text, upkeep, views  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
