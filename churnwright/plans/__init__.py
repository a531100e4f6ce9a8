"""Queries over the given tables."""

from churnwright.plans import checks, cleaning, features, joins, metrics, monitoring, profile, sources, splits, streams, training  # noqa: F401
from churnwright.plans.registry import ORACLE, QUERIES  # noqa: F401
