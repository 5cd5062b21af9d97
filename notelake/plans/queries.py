"""All registered queries with their SQL."""

from notelake.plans import job_queries, notebook_queries, table_queries  # noqa: F401  (registry)
from notelake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
