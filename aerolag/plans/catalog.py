"""All registered queries."""

from aerolag.plans import queries_features, queries_models, queries_profile, queries_training  # noqa: F401
from aerolag.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
