"""Windowed monitoring queries over an event table.

Events are first reduced to per-step partial counts (one map-side-combined
shuffle); every trailing window, ratio, quantile and alert then works on partials,
whose number depends on the time span and the series, not on the events.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from pyspark.sql.types import TimestampNTZType

# Bucket bounds, alert limits and the denominator guard.
LATENCY_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)
PROBABILITY_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
BATCH_BOUNDS = (1, 5, 10, 25, 50, 100, 250, 500, 1000)
MIN_RATE = 0.001
MINUTE, HOUR, DAY = 60, 3600, 86400


def epoch_seconds(df: DataFrame, ts: str) -> Column:
    """Whole epoch seconds of a timestamp column. One without time zone is read as
    UTC, whatever the session zone is."""
    if df.schema[ts].dataType == TimestampNTZType():
        start = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_diff("SECOND", start, F.col(ts))
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def step_start(df: DataFrame, ts: str, step: int) -> Column:
    """Start of the step a timestamp falls in, in epoch seconds."""
    seconds = epoch_seconds(df, ts)
    return seconds - F.pmod(seconds, F.lit(step))


def partials(
    df: DataFrame, ts: str, step: int, aggregates: Mapping[str, Column], keys: Sequence[str | Column] = ()
) -> DataFrame:
    """(slot, keys..., aggregates...) with slot = step start in epoch seconds."""
    return df.groupBy(step_start(df, ts, step).alias("slot"), *keys).agg(
        *[a.alias(n) for n, a in aggregates.items()]
    )


def counts_and_rates(df: DataFrame, ts: str, width: int, keys: Sequence[str] = ()) -> DataFrame:
    """(slot, keys..., n, rate) per tumbling window; rate is events per second."""
    counted = partials(df, ts, width, {"n": F.count("*")}, keys)
    return counted.withColumn("rate", F.col("n") / float(width))


# --- histograms --------------------------------------------------------------


def _bucket_name(i: int) -> str:
    return f"le_{i}"


def histogram_aggregates(value: str, bounds: Sequence[float]) -> dict[str, Column]:
    """Cumulative counts per bound plus count and sum: partials that add up."""
    c = F.col(value)
    out = {_bucket_name(i): F.count_if(c <= float(b)) for i, b in enumerate(bounds)}
    out["count"] = F.count(c)
    out["sum"] = F.sum(c)
    return out


def histogram_wide(
    df: DataFrame, value: str, bounds: Sequence[float], ts: str | None = None, width: int = DAY,
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row per (slot, keys): le_0..le_k, count, sum."""
    aggs = histogram_aggregates(value, bounds)
    if ts is None:
        return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return partials(df, ts, width, aggs, keys)


def histogram_long(wide: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """(..., le, cumulative), the last bucket being '+Inf'."""
    keep = [c for c in wide.columns if not c.startswith("le_") and c not in ("count", "sum")]
    rows = [
        F.struct(F.lit(f"{float(b):g}").alias("le"), F.col(_bucket_name(i)).alias("cumulative"))
        for i, b in enumerate(bounds)
    ]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("cumulative")))
    return wide.select(*keep, F.inline(F.array(*rows)))


def histogram_quantile(q: float, bounds: Sequence[float]) -> Column:
    """Quantile estimate from cumulative bucket columns.

    Linear inside the bucket that reaches the rank, starting from 0 below the first
    bound; a rank beyond the last finite bound yields that bound; NULL without data.
    """
    bounds = [float(b) for b in bounds]
    rank = F.col("count") * F.lit(float(q))
    out: Column = F.lit(bounds[-1])
    for i in reversed(range(len(bounds))):
        upto = F.col(_bucket_name(i))
        if i == 0:
            inside = (
                F.lit(bounds[0])
                if bounds[0] <= 0
                else F.lit(bounds[0]) * rank / F.nullif(upto, F.lit(0))
            )
        else:
            before = F.col(_bucket_name(i - 1))
            inside = F.lit(bounds[i - 1]) + F.lit(bounds[i] - bounds[i - 1]) * (rank - before) / F.nullif(
                upto - before, F.lit(0)
            )
        out = F.when(upto >= rank, inside).otherwise(out)
    return F.when(F.col("count") > 0, out)


def quantiles_of(wide: DataFrame, bounds: Sequence[float], probs: Mapping[str, float]) -> DataFrame:
    """Add one column per named quantile."""
    return wide.withColumns({n: histogram_quantile(q, bounds) for n, q in probs.items()})


# --- trailing windows on an evaluation grid ----------------------------------


#: Shortest stretch of the time axis that one task evaluates, in seconds.
CHUNK = 7 * 24 * 3600


def _chunk_seconds(step: int, width: int = 0) -> int:
    """Chunks are whole steps and at least as long as a trailing window."""
    return -(-max(CHUNK, width) // step) * step


def _same(keys: Sequence[str], *others: str) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    for c in others:
        condition = condition & (F.col(f"l.{c}") == F.col(f"r.{c}"))
    return condition


def on_grid(
    part: DataFrame,
    step: int,
    keys: Sequence[str],
    values: Sequence[str],
    idle: float | None = 0,
    width: int = 0,
    interval: tuple[int, int] | None = None,
) -> DataFrame:
    """Partials on every step of the evaluation interval, per series, with ``__chunk``; idle
    steps carry ``idle``. The size is series x (interval / step).

    ``interval`` (first and last slot) defaults to that of the data; giving it keeps a
    stray timestamp from stretching the grid. Chunks of the time axis are laid out first, each
    fills in its own steps: no task holds a whole series.
    """
    spark, length = part.sparkSession, _chunk_seconds(step, width)
    part = stored(part.select(*keys, "slot", *values), "partials")
    if interval is None:
        span = part.agg(F.min("slot"), F.max("slot")).first()
        interval = (span[0], span[1]) if span[0] is not None else (0, -step)
    lo, hi = interval[0] // step * step, interval[1] // step * step
    first, last = lo // length, hi // length
    if keys:
        chunks = F.sequence(F.lit(first), F.lit(last)) if last >= first else F.array()
        layout = part.select(*keys).distinct().withColumn("__chunk", F.explode(chunks.cast("array<bigint>")))
    else:
        layout = spark.range(first, last + 1).select(F.col("id").alias("__chunk"))
    start, stop = F.greatest(F.lit(lo), F.col("__chunk") * length), F.least(F.lit(hi), (F.col("__chunk") + 1) * length - step)
    slots = F.when(stop >= start, F.sequence(start, stop, F.lit(step).cast("long")))
    grid = layout.withColumn("slot", F.explode(slots)).alias("l")
    found = grid.join(part.alias("r"), _same(keys, "slot"), "left")
    here = F.col("r.slot").isNotNull()
    return found.select(
        *[F.col(f"l.{k}") for k in keys],
        "l.slot",
        *[F.when(here, F.col(f"r.{v}")).otherwise(F.lit(idle)).alias(v) for v in values],
        "l.__chunk",
    )


def trailing_sums(
    part: DataFrame,
    step: int,
    width: int,
    keys: Sequence[str],
    values: Sequence[str],
    grid: bool = True,
    interval: tuple[int, int] | None = None,
) -> DataFrame:
    """Replace each value by its sum over (slot end - width, slot end].

    With ``grid`` idle steps are evaluated too; otherwise only slots with events. A
    chunk of the time axis also gets the rows of one window width before it.
    """
    length = _chunk_seconds(step, width)
    if grid:
        rows = on_grid(part, step, keys, values, width=width, interval=interval)
    else:
        rows = part.select(*keys, "slot", *values).withColumn("__chunk", F.floor(F.col("slot") / length).cast("long"))
    late = F.col("slot") >= (F.col("__chunk") + 1) * length - (width - step)
    chunks = F.when(late, F.array(F.col("__chunk"), F.col("__chunk") + 1)).otherwise(F.array("__chunk"))
    both = rows.select(*keys, "slot", *values, F.col("__chunk").alias("__own"), F.explode(chunks).alias("__chunk"))
    window = Window.partitionBy(*keys, "__chunk").orderBy("slot").rangeBetween(-(width - step), 0)
    summed = both.withColumns({v: F.sum(v).over(window) for v in values})
    return summed.where("__own = __chunk").drop("__own", "__chunk")


def guarded_ratio(num: Column, den: Column, width: int, min_rate: float = MIN_RATE) -> Column:
    """rate(num) / max(rate(den), min_rate)."""
    floor = F.lit(min_rate * width)
    return num / F.when(den < floor, floor).otherwise(den)


def trailing_ratio(
    df: DataFrame,
    ts: str,
    hit: Column,
    step: int,
    width: int,
    keys: Sequence[str] = (),
    min_rate: float = MIN_RATE,
    interval: tuple[int, int] | None = None,
) -> DataFrame:
    """(keys..., slot, hits, total, ratio): share of hits in the trailing window."""
    part = partials(df, ts, step, {"hits": F.count_if(hit), "total": F.count("*")}, keys)
    sums = trailing_sums(part, step, width, keys, ["hits", "total"], interval=interval)
    return sums.withColumn("ratio", guarded_ratio(F.col("hits"), F.col("total"), width, min_rate))


def trailing_quantiles(
    df: DataFrame,
    ts: str,
    value: str,
    bounds: Sequence[float],
    probs: Mapping[str, float],
    step: int,
    width: int,
    keys: Sequence[str] = (),
    interval: tuple[int, int] | None = None,
) -> DataFrame:
    """Histogram quantiles over a trailing window, at every step."""
    aggs = {k: v for k, v in histogram_aggregates(value, bounds).items() if k != "sum"}
    part = partials(df, ts, step, aggs, keys)
    sums = trailing_sums(part, step, width, keys, list(aggs), interval=interval)
    return quantiles_of(sums, bounds, probs).select(*keys, "slot", "count", *probs)


def mean_batch_size(df: DataFrame, ts: str, size: str, width: int, keys: Sequence[str] = ()) -> DataFrame:
    """(slot, keys..., batches, records, mean_size) with the guarded denominator."""
    part = partials(df, ts, width, {"batches": F.count(size), "records": F.sum(size)}, keys)
    return part.withColumn("mean_size", guarded_ratio(F.col("records"), F.col("batches"), width))


# --- gauges ------------------------------------------------------------------


def last_gauge(df: DataFrame, ts: str, value: str, instance: str, tie: str | None = None) -> DataFrame:
    """(instance, value, ts): latest reading per instance, a combinable aggregate."""
    order = F.struct(ts, *( [tie] if tie else []))
    latest = F.max_by(F.struct(F.col(ts).alias("ts"), F.col(value).alias("value")), order)
    return df.groupBy(instance).agg(latest.alias("r")).select(instance, "r.value", "r.ts")


def gauge_overview(latest: DataFrame) -> DataFrame:
    """One row: instances, sum, max and how many read 0."""
    return latest.agg(
        F.count("*").alias("instances"),
        F.sum("value").alias("total"),
        F.max("value").alias("highest"),
        F.count_if(F.col("value") == 0).alias("at_zero"),
    )


# --- alerts ------------------------------------------------------------------


def holds_for(
    df: DataFrame, condition: Column, duration: int, keys: Sequence[str] = (), slot: str = "slot"
) -> DataFrame:
    """Add ``pending``, ``active_since`` and ``firing``.

    A condition fires once it held at every evaluation for ``duration`` seconds. An
    episode begins at the evaluation after the last false one. Chunks of the time axis are
    judged apart; a summary row per chunk carries that evaluation into the next ones.
    """
    keys = list(keys)
    flagged = df.withColumn("pending", F.coalesce(condition, F.lit(False))).withColumn(
        "__chunk", F.floor(F.col(slot) / CHUNK).cast("long")
    )
    order = Window.partitionBy(*keys, "__chunk").orderBy(slot)
    marked = flagged.withColumn("__after", F.lead(slot).over(order))
    stop = F.when(~F.col("pending"), F.struct(F.col(slot).alias("at"), F.col("__after").alias("after")))
    marked = marked.withColumn("__stop", F.max(stop).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    chunks = marked.groupBy(*keys, "__chunk").agg(F.min(slot).alias("first"), F.max(stop).alias("stop"))
    series = Window.partitionBy(*keys).orderBy("__chunk")
    ended = F.when(F.col("stop").isNotNull(), F.coalesce("stop.after", F.lead("first").over(series)))
    chunks = chunks.withColumn("ended", ended)
    chunks = chunks.select(
        *keys,
        "__chunk",
        F.coalesce(
            F.last("ended", ignorenulls=True).over(series.rowsBetween(Window.unboundedPreceding, -1)),
            F.min("first").over(Window.partitionBy(*keys)),
        ).alias("since"),
    )
    joined = marked.alias("l").join(chunks.alias("r"), _same(keys, "__chunk")).select("l.*", F.col("r.since").alias("__since"))
    since = F.when(F.col("__stop").isNotNull(), F.col("__stop.after")).otherwise(F.col("__since"))
    return (
        joined.withColumn("active_since", F.when(F.col("pending"), since))
        .withColumn("firing", F.col("pending") & (F.col(slot) - F.col("active_since") >= duration))
        .drop("__chunk", "__after", "__stop", "__since")
    )


def carried_forward(rows: DataFrame, value: str, keys: Sequence[str], slot: str = "slot") -> DataFrame:
    """Fill missing values by the last one before, chunk by chunk of the time axis."""
    keys = list(keys)
    chunked = rows.withColumn("__chunk", F.floor(F.col(slot) / CHUNK).cast("long"))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(slot).rowsBetween(Window.unboundedPreceding, 0)
    lasts = chunked.groupBy(*keys, "__chunk").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(slot))).alias("last"))
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    lasts = lasts.withColumn("last", F.last("last", ignorenulls=True).over(before))
    joined = chunked.alias("l").join(lasts.alias("r"), _same(keys, "__chunk")).select("l.*", F.col("r.last").alias("__carried"))
    filled = F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("__carried"))
    return joined.withColumn(value, filled).drop("__chunk", "__carried")


def alert_intervals(firing: DataFrame, keys: Sequence[str] = (), slot: str = "slot") -> DataFrame:
    """(keys..., active_since, fired_at, last_at, evaluations) per firing episode."""
    return (
        firing.where(F.col("firing"))
        .groupBy(*keys, "active_since")
        .agg(F.min(slot).alias("fired_at"), F.max(slot).alias("last_at"), F.count("*").alias("evaluations"))
    )


def latency_alert(df, ts, value, limit=0.5, q=0.95, step=MINUTE, width=5 * MINUTE, duration=5 * MINUTE,
                  bounds: Sequence[float] = LATENCY_BOUNDS, interval: tuple[int, int] | None = None) -> DataFrame:
    """Quantile of the trailing window above the limit for the duration."""
    rows = trailing_quantiles(df, ts, value, bounds, {"quantile": q}, step, width, interval=interval)
    return holds_for(rows, F.col("quantile") > limit, duration)


def error_ratio_alert(df, ts, failed: Column, limit=0.05, step=MINUTE, width=5 * MINUTE,
                      duration=5 * MINUTE, interval: tuple[int, int] | None = None) -> DataFrame:
    """Share of failed requests above the limit for the duration."""
    return holds_for(trailing_ratio(df, ts, failed, step, width, interval=interval), F.col("ratio") > limit, duration)


def error_burst_alert(df, ts, error_type, limit=5, step=MINUTE, width=10 * MINUTE,
                      interval: tuple[int, int] | None = None) -> DataFrame:
    """More than ``limit`` errors of one type in the trailing window, at once."""
    errors = df.where(F.col(error_type).isNotNull())
    part = partials(errors, ts, step, {"errors": F.count("*")}, [error_type])
    sums = trailing_sums(part, step, width, [error_type], ["errors"], interval=interval)
    return holds_for(sums, F.col("errors") > limit, 0, [error_type])


def approval_rate_alert(df, ts, approved: Column, low: float | None = 0.20, high: float | None = 0.90,
                        step=MINUTE, width=30 * MINUTE, duration=15 * MINUTE, min_events: int = 0,
                        interval: tuple[int, int] | None = None) -> DataFrame:
    """Approval rate outside the band for the duration.

    An idle series has ratio 0 and so counts as collapsed; ``min_events`` demands
    that many decisions in the window first.
    """
    rows = trailing_ratio(df, ts, approved, step, width, interval=interval)
    out = F.lit(False)
    if high is not None:
        out = out | (F.col("ratio") > high)
    if low is not None:
        out = out | (F.col("ratio") < low)
    return holds_for(rows, out & (F.col("total") >= min_events), duration)


def no_traffic_alert(df, ts, step=MINUTE, width=15 * MINUTE, duration=15 * MINUTE,
                     keys: Sequence[str] = (), interval: tuple[int, int] | None = None) -> DataFrame:
    """Nothing at all in the trailing window, for the duration."""
    part = partials(df, ts, step, {"n": F.count("*")}, keys)
    return holds_for(trailing_sums(part, step, width, keys, ["n"], interval=interval), F.col("n") == 0, duration, keys)


def gauge_alert(df, ts, value, instance, duration, step=MINUTE, equals: float = 0.0, tie: str | None = None,
                interval: tuple[int, int] | None = None) -> DataFrame:
    """The gauge of an instance reads ``equals`` for the duration: last reading per
    step, carried forward over steps without a reading. Of readings at one instant the
    one with the largest ``tie`` is the last, without it the largest reading."""
    order = F.struct(F.col(ts), F.col(tie or value))
    part = partials(df, ts, step, {"value": F.max_by(value, order)}, [instance])
    grid = on_grid(part, step, [instance], ["value"], idle=None, interval=interval).drop("__chunk")
    filled = carried_forward(grid, "value", [instance])
    return holds_for(filled, F.col("value") == equals, duration, [instance])
