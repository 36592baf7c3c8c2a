from opsflow.catalog import datasets, documents, extracts, functions, groups, longform, partners, reports, state, updates  # noqa: F401
from opsflow.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
