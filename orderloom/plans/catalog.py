"""All registered queries and their checks."""

from orderloom.plans import (  # noqa: F401
    catalog_clean,
    catalog_models,
    catalog_relational,
    catalog_reports,
    catalog_store,
    catalog_stream,
)
from orderloom.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
