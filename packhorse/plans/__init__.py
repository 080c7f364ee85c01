"""The registered queries, each beside the SQL that checks it."""

from packhorse.plans import analytics, history, load, quality, streams
from packhorse.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analytics", "history", "load", "quality", "streams"]
