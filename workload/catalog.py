"""All registered queries."""

from workload import features, marts, runs, training  # noqa: F401
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
