"""Importing this module registers every query."""

from parlance.plans import (  # noqa: F401
    catalog_joins,
    catalog_reports,
    catalog_scalars,
    catalog_sources,
    catalog_streams,
)
from parlance.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
