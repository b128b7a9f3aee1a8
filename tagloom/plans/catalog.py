"""All registered queries."""

from tagloom.plans import context, hierarchies, reads, states, streams, writes  # noqa: F401
from tagloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
