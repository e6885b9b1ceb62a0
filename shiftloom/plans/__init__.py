"""Registered queries over the benchmark tables, each with its check SQL."""

from shiftloom.plans import association, conversations, intervals, oee, scalars, sensors, sources, stops  # noqa: F401
from shiftloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
