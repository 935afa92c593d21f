"""Mix sources to target weights along a time-varying curriculum.

Every source has a target number of words and a weight schedule over training time
[0, 1]. Its share of the words due by time t is the integral of the schedule up to t;
a document that stands at cumulative demand u of its source is read where that
integral reaches u. Sorting all documents by that position by range gives the order.

Defined results: a null text has size 0 and is taken as often as its source's whole
passes; a null source is a source of its own, sorted last; rows that agree in id and
text are interchangeable; an empty table gives an empty plan. Only the three named
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, running_total

#: (time, weight) knots, by rank of the source, repeating: early, even and late sources.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)),
)


def source_targets(sizes: DataFrame, weights: Sequence[int], budget: float, cap: float) -> DataFrame:
    """(source, rank, source_size, weight, target) from (source, source_size).

    ``budget`` times all words are shared by weight; no target exceeds ``cap`` times its
    source. With the sources in order of cap by weight, the level at which the shares
    settle follows from two running sums; resharing step by step ends at the same level.
    One row per source: the windows see as many rows as there are sources.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    filled = F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(every) * F.lit(float(budget)) - filled) / open_weight
    levels = ranked.withColumn("level", level)
    # the first source in that order whose share stays below its own cap sets the level
    within = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct(F.col("limit") / F.col("weight"), "rank", "level"))
    settled = F.min(within).over(every)["level"]
    target = F.least(F.col("limit"), F.coalesce(settled * F.col("weight"), F.col("limit")))
    return levels.withColumn("target", target).select("source", "rank", "source_size", "weight", "target")


def _inverse_integral(u, rank, schedules):
    """Time at which the integral of the schedule of this rank reaches the share u of its total."""

    def one(knots):
        pieces, done = [], 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            area = (w0 + w1) / 2 * (t1 - t0)
            pieces.append((t0, t1, w0, w1, done, done + area))
            done += area
        out = F.lit(float(knots[-1][0]))
        for t0, t1, w0, w1, before, after in reversed(pieces):
            due = u * done - before
            slope = (w1 - w0) / (t1 - t0)
            if slope == 0:
                t = t0 + due / w0
            else:
                t = t0 + (F.sqrt(F.greatest(F.lit(w0 * w0) + due * (2 * slope), F.lit(0.0))) - w0) / slope
            out = F.when(u * done <= after, t).otherwise(out)
        return out

    out = one(schedules[-1])
    for k, knots in enumerate(schedules[:-1]):
        out = F.when(rank % len(schedules) == k, one(knots)).otherwise(out)
    return out


def plan_mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    budget: float = 1.5,
    cap: int = 2,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    seed: int = 0,
    bucket_digits: int = 3,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep_rows: bool = False,
) -> DataFrame:
    """One row per document: (doc_id, digest, size, source, source_size, target, taken, positions).

    Documents of a source stand in the order of a digest of id, text and ``seed``. All are
    taken as many whole times as the target allows, and once more until the middle of a
    document passes the rest of the target: a source ends within half a document of it.
    ``positions`` has one entry for each time the document is taken.
    Sizes are added up by digest prefix first, so a hot source is spread over
    16 ** bucket_digits window partitions. ``keep_rows`` adds the whole input row as ``row``.
    """
    kept = ["row"] if keep_rows else []
    body = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        *[F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(c) for c in kept],
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), body, F.lit(str(seed))).cast("binary")).alias("digest"),
    ).withColumn("bucket", F.substring("digest", 1, bucket_digits))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, budget, cap)
    placed = running_total(rows, ["source"], ["digest"], "size", "bucket", "before")
    full = placed.alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select(
        *[f"p.{c}" for c in kept], "p.doc_id", "p.digest", "p.size", "p.source", "p.before", "t.rank", "t.source_size", "t.target"
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1))
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    middle = F.col("before") + F.col("size") / 2.0
    full = full.withColumn("passes", passes.cast("int"))
    times = F.col("passes") + F.when((F.col("size") > 0) & (middle < rest), F.lit(1)).otherwise(F.lit(0))
    full = full.withColumn("times", times.cast("int"))

    def at(n):
        u = F.when(F.col("target") > 0, (n * F.col("source_size") + middle) / F.col("target")).otherwise(F.lit(0.0))
        return F.round(_inverse_integral(F.least(u, F.lit(1.0)), F.col("rank"), schedules), 9)

    positions = F.slice(F.array(*[at(n) for n in range(cap + 1)]), F.lit(1), F.col("times"))
    return full.select(
        *kept, "doc_id", "digest", "size", "source", "source_size", "target",
        (F.col("times") * F.col("size")).cast("long").alias("taken"), positions.alias("positions"),
    )


def in_training_order(docs: DataFrame, **settings) -> DataFrame:
    """The documents, with all their columns, as often as the mix takes them, range-sorted by position.

    Rows travel with their plan, so that repeated rows need no numbering.
    """
    plan = plan_mix(docs, keep_rows=True, **settings)
    placed = plan.select("doc_id", "digest", "row", F.explode("positions").alias("position"))
    return placed.repartitionByRange("position", "digest").sortWithinPartitions("position", "digest").select("row.*")
