"""All registered queries."""

from rhythmica.plans import evaluation_queries, feature_queries, forecast_queries, io_queries  # noqa: F401
from rhythmica.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
