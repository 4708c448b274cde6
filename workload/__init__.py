"""Registered queries over the given tables, each with equal SQL where SQL can say it."""

from workload.registry import ORACLES, QUERIES
from workload import measures, properties, edges, vectors, learned, molecules  # noqa: F401  (they register on import)

__all__ = ["ORACLES", "QUERIES"]
