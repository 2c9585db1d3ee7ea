"""The library's operators bound to the shop tables."""

from depotline.plans import checks, ingestion, marts, transforms
from depotline.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "checks", "ingestion", "marts", "transforms"]
