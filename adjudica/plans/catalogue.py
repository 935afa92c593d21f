"""All registered queries."""

from . import (  # noqa: F401
    contract_queries,
    drift_queries,
    feature_queries,
    fitted_queries,
    metric_queries,
    model_queries,
    monitor_queries,
    profile_queries,
    sampling_queries,
    source_queries,
    stream_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
