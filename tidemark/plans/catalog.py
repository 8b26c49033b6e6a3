"""All queries of the analytics library by name, each with its SQL where SQL can express it."""

from tidemark.plans import aggregates, calendars, evaluation, joins, numbers, scans, streams, texts, trends, windows  # noqa: F401
from tidemark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
