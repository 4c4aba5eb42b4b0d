"""Imports every query module so that the registry is complete."""

from skyframe.plans import q_flights, q_quality, q_samples, q_sources, q_stats, q_streaming, q_text  # noqa: F401
from skyframe.plans.registry import ORACLE, QUERIES  # noqa: F401
