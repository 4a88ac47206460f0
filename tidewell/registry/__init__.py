"""All registered queries."""

from tidewell.registry import cleaning, formats, models, projections, quality, statistics, streams  # noqa: F401
from tidewell.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
