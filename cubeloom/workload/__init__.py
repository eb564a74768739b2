from cubeloom.workload import (
    audit_queries,
    cube_queries,
    facts_queries,
    file_queries,
    history_queries,
)
from cubeloom.workload.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "audit_queries",
    "cube_queries",
    "facts_queries",
    "file_queries",
    "history_queries",
]
