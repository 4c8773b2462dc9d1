"""The operators applied to the driver's tables, each with its SQL counterpart."""

from cohortweave.catalog import care, cohort, features, sources, studies, weight  # noqa: F401  (they register queries)
from cohortweave.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
