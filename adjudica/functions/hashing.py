"""Reproducible pseudo-random draws keyed by row identity.

``rand(seed)`` depends on how rows are laid out over partitions; a digest of
(key, purpose, seed) does not, so a retried or re-partitioned task draws the
same numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX = 13  # 52 bits, the widest prefix a double holds exactly
_SPAN = float(1 << 52)


def hash_key(key: Column, seed: int | str) -> Column:
    """Lower-case hex digest whose string order is the shuffle order of rows."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def row_digest(*columns: Column) -> tuple[Column, Column]:
    """128 bits that identify the values of some columns, nulls included, as two longs.

    Fixed-width keys: grouping by them hashes, and long texts stay out of the shuffle.
    """
    gaps = [c.isNull() for c in columns]
    return F.xxhash64(*columns, *gaps), F.xxhash64(F.lit("second"), *columns, *gaps)


def uniform(key: Column, purpose: str, seed: int | str) -> Column:
    """Uniform draw in [0, 1) for this key and purpose."""
    digest = hash_key(key, f"{purpose}|{seed}")
    return F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("double") / _SPAN


def normal(key: Column, purpose: str, seed: int | str) -> Column:
    """Standard normal draw (Box-Muller on two uniforms)."""
    radius = F.sqrt(-2.0 * F.log(1.0 - uniform(key, f"{purpose}.r", seed)))
    return radius * F.cos(2.0 * math.pi * uniform(key, f"{purpose}.a", seed))
