"""The registered queries, each next to the SQL that must give the same rows."""

from workload import composites, deletes, graph, reads, rules, stores, vectors, writes  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
