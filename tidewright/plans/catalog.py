"""Imports every query module and exposes the registry."""

from . import (  # noqa: F401
    q_aggregates,
    q_alarms,
    q_closed,
    q_density,
    q_fill,
    q_models,
    q_runs,
    q_scale,
    q_sources,
    q_streams,
    q_windows,
)
from .registry import oracle_queries, spark_queries  # noqa: F401
