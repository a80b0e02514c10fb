"""Registered queries: each one a plan over the given tables with its check in SQL."""

from txscore.plans import (
    cleaning_plans, exploration_plans, feature_plans, io_plans, model_plans, profiling_plans,
    serving_plans, stream_plans,
)
from txscore.plans.registry import ORACLES, PLANS

__all__ = [
    "ORACLES", "PLANS", "cleaning_plans", "exploration_plans", "feature_plans", "io_plans",
    "model_plans", "profiling_plans", "serving_plans", "stream_plans",
]
