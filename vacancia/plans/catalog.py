"""Importing this module registers every query."""

from vacancia.plans import reports_matching, reports_models, reports_stats, reports_tables  # noqa: F401
from vacancia.plans.registry import CATALOG

__all__ = ["CATALOG"]
