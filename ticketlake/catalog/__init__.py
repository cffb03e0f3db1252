"""Queries over the given tables, one per operator, with their check SQL."""

from ticketlake.catalog import cube, gold, ingest, orders, reports, rules, text  # noqa: F401
from ticketlake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
