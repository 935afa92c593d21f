"""Bucket expressions. Two conventions live here and must not be mixed:

* histogram bins of the drift index are left-closed: [e_i, e_{i+1})
* latency-style monitoring buckets are right-closed: v <= le
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def left_closed_index(c: Column, inner_edges: Sequence[float]) -> Column:
    """Number of inner edges that are <= c, NULL for NULL.

    Built as a balanced tree of comparisons: log2(edges) tests per row, all
    inside generated code. Meant for a few dozen edges; use an ML ``Bucketizer``
    for hundreds.
    """
    edges = sorted(float(e) for e in inner_edges)

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c >= edges[mid], tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return F.when(c.isNotNull(), tree(0, len(edges)))


def right_closed_cumulative(c: Column, bounds: Sequence[float]) -> list[Column]:
    """One cumulative count aggregate per finite bound (``v <= le``)."""
    return [F.count_if(c <= float(b)) for b in bounds]
