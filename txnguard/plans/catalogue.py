"""Importing this module registers every query."""

from txnguard.plans import evaluation, featurize, models, reports, rules, slow, streams  # noqa: F401
from txnguard.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
