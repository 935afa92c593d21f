"""Exact quantiles that never hold a column in one task.

The built-in ``percentile`` keeps a value -> count map of the whole column in a
single task. Here the wanted order statistics are located by narrowing closed value
ranges ("segments") until each holds few rows:

* a segment is cut into buckets, and one map-side-combined count per bucket (with its
  smallest and largest value) says which bucket holds each wanted rank;
* a bucket whose smallest and largest value agree is the answer, however many rows it
  has: a value that fills a third of the table is never ranked;
* small segments are collapsed to (value, count) and ranked, one bounded segment per
  window partition.

Buckets are of equal width as long as that works. Where most rows stay in one bucket
(heavy tails, infinities) a sketch proposes the next cuts; it balances work and never
decides a result. Each pass divides the rows in play by up to ``BUCKETS``: a table of
10^12 evenly spread rows needs two.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import to_number
from ..session import small_table

BUCKETS = 4096
SPLITS = 1024  # cuts asked of a sketch
SEGMENT_ROWS = 1_000_000  # rows one ranking task may hold
RANK_AT_ONCE = 20_000  # rows not worth another pass


def numeric_view(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, coerced to double, NaN and junk as NULL."""
    return df.select(*[to_number(F.col(c), df.schema[c].dataType).alias(c) for c in columns])


def sketch_splits(df: DataFrame, columns: Sequence[str], buckets: int) -> dict[str, list[float]]:
    """Increasing split points per column, from a mergeable sketch.

    The driver receives at most ``buckets`` doubles per column.
    """
    if not columns or buckets < 2:
        return {c: [] for c in columns}
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(
        *[F.percentile_approx(F.col(c), probs, 2 * buckets).alias(c) for c in columns]
    ).first()
    return {c: sorted({v for v in (row[c] or []) if math.isfinite(v)}) for c in columns}


def with_range_bucket(df: DataFrame, source: str, splits: Sequence[float], output: str) -> DataFrame:
    """Add the left-closed bucket number of a double column (binary search, JVM side)."""
    if not splits:
        return df.withColumn(output, F.when(F.col(source).isNotNull(), F.lit(0)))
    found = Bucketizer(
        splits=[-math.inf, *splits, math.inf], inputCol=source, outputCol=output, handleInvalid="keep"
    ).transform(df)
    return found.withColumn(output, F.col(output).cast("int"))


@dataclass
class _Segment:
    """Rows of ``column`` with low <= value <= high, and the ranks wanted among them.
    ``low`` and ``high`` are values that occur."""

    column: str
    low: float
    high: float
    rows: int
    ranks: dict[int, int]  # rank in the column -> rank inside the segment
    by_sketch: bool = False

    def holds(self) -> Column:
        c = F.col(self.column)
        return (c >= self.low) & (c <= self.high)

    def even_width(self) -> float | None:
        """Width of an equal-width bucket, where arithmetic on the range is safe."""
        width = (self.high - self.low) / BUCKETS
        return width if 1e-290 < width < math.inf and not self.by_sketch else None


def _entries(values: DataFrame, segments: list[_Segment]) -> DataFrame:
    """(segment, value) of the values inside any segment: one entry per column and
    row at most, as the segments of a column are disjoint."""
    by_column: dict[str, Column] = {}
    inside = F.lit(False)
    for i, s in enumerate(segments):
        found = by_column.get(s.column)
        by_column[s.column] = F.when(s.holds(), i) if found is None else found.when(s.holds(), i)
        inside = inside | s.holds()
    entries = [
        F.struct(found.alias("segment"), F.col(c).alias("value")) for c, found in by_column.items()
    ]
    # the row filter lets the scan skip what no segment needs
    long = values.where(inside).select(F.inline(F.array(*entries)))
    return long.where(F.col("segment").isNotNull())


def _bucket_view(values: DataFrame, segments: list[_Segment]) -> DataFrame:
    """(segment, bucket, value): bucket numbers ascend with the value."""
    long = _entries(values, segments)
    widths = small_table(
        long.sparkSession,
        [(i, s.low, s.even_width()) for i, s in enumerate(segments)],
        "segment int, low double, width double",
    )
    long = long.join(F.broadcast(widths), "segment")  # one row per segment
    even = F.floor((F.col("value") - F.col("low")) / F.col("width"))
    bucket = F.least(even, F.lit(BUCKETS - 1)).cast("int")

    sketched = [i for i, s in enumerate(segments) if s.even_width() is None]
    if sketched:
        own = {i: F.when(F.col("segment") == i, F.col("value")).alias(f"v{i}") for i in sketched}
        splits = sketch_splits(long.select(*own.values()), [f"v{i}" for i in sketched], SPLITS)
        long = long.select("*", *own.values())
        found = bucket
        for i in sketched:
            # v and the next double after it: a frequent value becomes a bucket of its own
            inner = {e for v in splits[f"v{i}"] for e in (v, math.nextafter(v, math.inf))}
            long = with_range_bucket(long, f"v{i}", sorted(inner), f"b{i}")
            found = F.when(F.col("segment") == i, F.col(f"b{i}")).otherwise(found)
        bucket = found
    return long.select("segment", bucket.alias("bucket"), "value")


def _narrow(values: DataFrame, segments: list[_Segment], found: dict) -> list[_Segment]:
    """Replace each segment by those of its buckets that hold a wanted rank."""
    counted = (
        _bucket_view(values, segments)
        .groupBy("segment", "bucket")
        .agg(F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
        .collect()  # at most BUCKETS rows per segment
    )
    out: list[_Segment] = []
    for i, segment in enumerate(segments):
        todo, upto = sorted(segment.ranks.items(), key=lambda kv: kv[1]), 0
        for b in sorted((r for r in counted if r.segment == i), key=lambda r: r.bucket):
            hits = {}
            while todo and todo[0][1] < upto + b.rows:
                rank, inside = todo.pop(0)
                hits[rank] = inside - upto
            upto += b.rows
            if hits and b.low == b.high:
                found.update({(segment.column, rank): b.low for rank in hits})
            elif hits:
                crowded = b.rows * 16 > segment.rows
                out.append(_Segment(segment.column, b.low, b.high, b.rows, hits, crowded))
    return out


def _rank_small(values: DataFrame, segments: list[_Segment], found: dict) -> None:
    collapsed = _entries(values, segments).groupBy("segment", "value").count()
    upto = F.sum("count").over(Window.partitionBy("segment").orderBy("value"))
    targets = small_table(
        values.sparkSession,
        [(i, inside) for i, s in enumerate(segments) for inside in set(s.ranks.values())],
        "segment int, inside long",
    )
    reached = (F.col("inside") < F.col("upto")) & (F.col("inside") >= F.col("upto") - F.col("count"))
    hits = (
        collapsed.withColumn("upto", upto)
        .join(F.broadcast(targets), "segment")  # two rows per column and probability
        .where(reached)
        .select("segment", "inside", "value")
        .collect()
    )
    value_at = {(r.segment, r.inside): r.value for r in hits}
    for i, s in enumerate(segments):
        found.update({(s.column, rank): value_at[(i, inside)] for rank, inside in s.ranks.items()})


def _interpolate(rows: int, prob: float, value_at) -> float:
    position = prob * (rows - 1)
    low, high = math.floor(position), math.ceil(position)
    below, above = value_at(low), value_at(high)
    if below == above:
        return below
    return (high - position) * below + (position - low) * above


_SHAPE = {"n": F.count, "l": F.min, "h": F.max}


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    segment_rows: int | None = None,
) -> dict[str, list[float] | None]:
    """Linear-interpolation quantiles of each column, NULLs ignored.

    A fit step: it runs jobs and returns ``len(columns) * len(probs)`` numbers.
    A column without values maps to None. ``segment_rows`` lowers the number of rows
    that are ranked directly.
    """
    columns = list(columns)
    if not columns:
        return {}
    at_once = RANK_AT_ONCE if segment_rows is None else segment_rows
    limit = SEGMENT_ROWS if segment_rows is None else segment_rows
    values = numeric_view(df, columns)
    shape = values.agg(
        *[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in _SHAPE.items()]
    ).first()
    counts = {c: shape[f"n{i}"] for i, c in enumerate(columns)}

    found: dict[tuple[str, int], float] = {}
    pending = []
    for i, c in enumerate(columns):
        positions = [p * (counts[c] - 1) for p in probs] if counts[c] else []
        ranks = {r for p in positions for r in (math.floor(p), math.ceil(p))}
        low, high = shape[f"l{i}"], shape[f"h{i}"]
        if ranks and low == high:
            found.update({(c, r): low for r in ranks})
        elif ranks:
            pending.append(_Segment(c, low, high, counts[c], {r: r for r in ranks}))
    small = [s for s in pending if s.rows <= at_once]
    large = [s for s in pending if s.rows > at_once]
    while large:
        narrowed = _narrow(values, large, found)
        small += [s for s in narrowed if s.rows <= limit]
        large = [s for s in narrowed if s.rows > limit]
    if small:
        _rank_small(values, small, found)
    return {
        c: [_interpolate(counts[c], p, lambda r, c=c: found[(c, r)]) for p in probs]
        if counts[c]
        else None
        for c in columns
    }


def exact_medians(
    df: DataFrame, columns: Sequence[str], segment_rows: int | None = None
) -> dict[str, float | None]:
    """Exact median per column; None where a column has no values."""
    fitted = exact_quantiles(df, columns, [0.5], segment_rows)
    return {c: (q[0] if q else None) for c, q in fitted.items()}
