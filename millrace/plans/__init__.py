"""All registered queries."""

from millrace.plans import pages, streams, tables  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
