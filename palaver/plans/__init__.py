"""Registered queries over the board model."""

from palaver.plans import assigning, details, late, linkage, passes, recovering, relational, reports, rewriting, scalars  # noqa: F401
from palaver.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
