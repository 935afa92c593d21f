"""Column expressions: everything here stays inside Catalyst, no Python UDFs."""

from .buckets import left_closed_index, right_closed_cumulative
from .hashing import hash_key, normal, uniform
from .numeric import clamp_min, clip, finite_or_null, safe_ratio, to_number
from .text import cut_at_marker, percent

__all__ = [
    "clamp_min",
    "clip",
    "cut_at_marker",
    "finite_or_null",
    "hash_key",
    "left_closed_index",
    "normal",
    "percent",
    "right_closed_cumulative",
    "safe_ratio",
    "to_number",
    "uniform",
]
