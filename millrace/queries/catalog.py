"""All registered queries."""

from millrace.queries import feeds, logs, stages, streams  # noqa: F401
from millrace.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
