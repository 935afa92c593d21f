"""Mergeable quantile sketches, one for each slot of time and feature, kept as a table.

The sketches of any range of slots merge into the quantiles of that range: a reference profile for drift needs no second look at
the rows. A sketch with parameter k keeps all values while there are few of them, and from then on places a value at a rank
that is off by at most ``rank_error(k)`` of the rows, with 99 % confidence, however many sketches were merged. Each takes a few times k numbers.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_table, stored
from .drift import DriftProfile, inner_edges
from .monitor import DAY, step_start

K = 4096
SCHEMA = "slot long, feature string, rows long, sketch binary"


def rank_error(k: int = K) -> float:
    """Share of the rows by which a rank may be off (published bound of the sketch, both sides of a range of values)."""
    return 2.446 / k**0.9433


def _values(df: DataFrame, numeric: Sequence[str], keys: Sequence[Column]) -> DataFrame:
    """(keys..., feature, value) without missing values."""
    wide = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in numeric])
    names = [c for c in wide.columns if c not in numeric]
    long = wide.unpivot(names, list(numeric), "feature", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def sketch_table(df: DataFrame, ts: str, numeric: Sequence[str], step: int = DAY, k: int = K) -> DataFrame:
    """(slot, feature, rows, sketch): sketches are built on the map side and merged, so only sketches travel."""
    rows = _values(df, numeric, [step_start(df, ts, step).alias("slot")])
    return rows.groupBy("slot", "feature").agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch")
    )


def merged(sketches: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """(feature, rows, sketch) of the slots from ``first`` to ``last``, both included."""
    chosen = sketches
    if first is not None:
        chosen = chosen.where(F.col("slot") >= first)
    if last is not None:
        chosen = chosen.where(F.col("slot") <= last)
    return chosen.groupBy("feature").agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(merged_sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(feature, rows, prob, value): the least value with at least that share of the rows up to it, within the rank error."""
    places = F.lit([float(p) for p in probs])
    found = F.arrays_zip(places.alias("prob"), F.kll_sketch_get_quantile_double("sketch", places).alias("value"))
    return merged_sketches.select("feature", "rows", F.inline(found).alias("prob", "value"))


def shares(merged_sketches: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, bucket, share) of left-closed buckets between the inner edges, from the ranks of the edges."""
    below = F.lit(None).cast("array<double>")
    for feature, inner in edges.items():
        # the largest number below an edge is still on its left
        left = F.lit([math.nextafter(float(e), -math.inf) for e in inner])
        below = F.when(F.col("feature") == feature, F.kll_sketch_get_rank_double("sketch", left)).otherwise(below)
    ranks = merged_sketches.select("feature", below.alias("below")).where("below is not null")
    upto = F.concat("below", F.array(F.lit(1.0)))
    since = F.concat(F.array(F.lit(0.0)), "below")
    each = ranks.select("feature", F.posexplode(F.zip_with(upto, since, lambda b, a: b - a)).alias("bucket", "share"))
    return each.where("share > 0").select("feature", F.col("bucket").cast("string").alias("bucket"), "share")


def edges_of(merged_sketches: DataFrame, bins: int = 10) -> dict[str, list[float] | None]:
    """Inner bin edges of each feature, as a drift profile takes them from its reference. The driver reads ``bins`` + 1 numbers a feature."""
    found: dict[str, dict[float, float]] = {}
    for r in quantiles(merged_sketches, [i / bins for i in range(bins + 1)]).collect():
        found.setdefault(r.feature, {})[r.prob] = r.value
    return {f: inner_edges([v for _, v in sorted(q.items())]) for f, q in found.items()}


def profile_of(sketches: DataFrame, numeric: Sequence[str], first: int | None = None, last: int | None = None, bins: int = 10) -> DriftProfile:
    """Drift profile of a range of slots, from the stored sketches alone. Numeric features only: categories need no sketch."""
    held = stored(merged(sketches.where(F.col("feature").isin(*numeric)), first, last), "merged-sketches")
    edges = {c: None for c in numeric} | edges_of(held, bins)
    binned = {f: e for f, e in edges.items() if e is not None}
    rows = {r.feature: r.rows for r in held.select("feature", "rows").collect()}
    spark = sketches.sparkSession
    table = shares(held, binned) if binned else small_table(spark, [], "feature string, bucket string, share double")
    return DriftProfile(list(numeric), [], edges, table, max(rows.values(), default=0), {c: c in rows for c in numeric})
