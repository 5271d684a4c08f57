"""All registered queries."""

from . import change_queries, control_queries, ctes, operator_queries, warehouse_queries  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
