"""Registered queries: each operator on the test tables, with its SQL oracle."""

from tidemark.plans.registry import ORACLES, QUERIES
from tidemark.plans import basics, boxes, changes, messages, series, storage, streams, trends  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
