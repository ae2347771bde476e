from tidemark.queries import changes, columns, dml, enrich, jobs, quality, scans  # noqa: F401
from tidemark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
