"""Imports every module that registers queries."""

from docketry.plans import archives, casework, checks, cleaning, exchange, flows, ingest, joined, papers, ranks, records, rows, scalars, totals  # noqa: F401
from docketry.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
