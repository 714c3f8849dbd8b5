"""Registered queries, one module per family."""

from tidemark.plans.registry import ORACLES, QUERIES
from tidemark.plans import aggregates, checks, flows, joins, learning, projections, scalars, scans, sinks, streams  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
