"""Imports every query module, which registers its queries."""

from checks import q_counts, q_events, q_jobs, q_measures, q_packages, q_rollups, q_serving, q_travel  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401
