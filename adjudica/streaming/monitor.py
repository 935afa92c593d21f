"""Monitoring queries on a stream: the batch aggregates inside event-time windows.

Append mode: a window is emitted once, when the watermark passes its end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.drift import DriftProfile, bucket_rows, classify, psi_by_window
from ..operators.monitor import guarded_ratio, histogram_aggregates


def _seconds(width: int) -> str:
    return f"{width} seconds"


def _slot(window: Column) -> Column:
    return F.unix_timestamp(window["start"])


def windowed(
    stream: DataFrame,
    ts: str,
    width: int,
    aggregates: Mapping[str, Column],
    keys: Sequence[str] = (),
    delay: str | None = "10 minutes",
    timed: bool = False,
) -> DataFrame:
    """(slot, keys..., aggregates...) per tumbling window; with ``timed`` also ``at``, which carries the watermark
    on to a further stateful step. ``delay`` None keeps the watermark that the stream has."""
    marked = stream.withWatermark(ts, delay) if delay else stream
    return (
        marked.groupBy(F.window(ts, _seconds(width)).alias("w"), *keys)
        .agg(*[a.alias(n) for n, a in aggregates.items()])
        .select(_slot(F.col("w")).alias("slot"), *keys, *aggregates, *_event_time("w", timed))
    )


def _event_time(window: str, timed: bool) -> list[Column]:
    return [F.window_time(window).alias("at")] if timed else []


def counts_and_rates(
    stream: DataFrame, ts: str, width: int, keys: Sequence[str] = (), delay: str = "10 minutes"
) -> DataFrame:
    counted = windowed(stream, ts, width, {"n": F.count("*")}, keys, delay)
    return counted.withColumn("rate", F.col("n") / float(width))


def histogram(
    stream: DataFrame, ts: str, value: str, bounds: Sequence[float], width: int, delay: str = "10 minutes"
) -> DataFrame:
    """Cumulative bucket counts per window; quantiles are expressions over its row."""
    return windowed(stream, ts, width, histogram_aggregates(value, bounds), (), delay)


def trailing(
    stream: DataFrame,
    ts: str,
    step: int,
    width: int,
    aggregates: Mapping[str, Column],
    keys: Sequence[str] = (),
    delay: str = "10 minutes",
    timed: bool = False,
) -> DataFrame:
    """Sums over a trailing window at every step, from per-step partial counts.

    Sliding over partials instead of events: each event is counted once, and only
    one row per step is copied into its width/step windows. The slot is that of the
    window's last step, as in the batch form; a window without events has no row.
    """
    partial = (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, _seconds(step)).alias("w"), *keys)
        .agg(*[a.alias(n) for n, a in aggregates.items()])
        .withColumn("at", F.window_time("w"))
    )
    slid = partial.groupBy(F.window("at", _seconds(width), _seconds(step)).alias("v"), *keys).agg(
        *[F.sum(n).alias(n) for n in aggregates]
    )
    return slid.select(
        (F.unix_timestamp(F.col("v")["end"]) - step).alias("slot"), *keys, *aggregates, *_event_time("v", timed)
    )


def trailing_ratio(
    stream: DataFrame,
    ts: str,
    hit: Column,
    step: int,
    width: int,
    keys: Sequence[str] = (),
    delay: str = "10 minutes",
    timed: bool = False,
) -> DataFrame:
    sums = trailing(stream, ts, step, width, {"hits": F.count_if(hit), "total": F.count("*")}, keys, delay, timed)
    return sums.withColumn("ratio", guarded_ratio(F.col("hits"), F.col("total"), width))


def dedupe(
    stream: DataFrame, key: Sequence[str], ts: str, delay: str = "1 hour", salts: int = 16
) -> DataFrame:
    """One row per key; keys are remembered for the watermark delay.

    Rows later than the watermark are dropped before they can stand for their key. Two
    stateful steps, first by key and a salt, then by key: of a key that fills a third
    of the stream, at most ``salts`` rows a batch reach the task that owns the key. The salt is
    a hash of the row, so that a retried batch repeats it.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in stream.columns]), F.lit(salts))
    marked = stream.withColumn("__salt", salt).withWatermark(ts, delay)
    once = marked.dropDuplicatesWithinWatermark([*key, "__salt"])
    return once.dropDuplicatesWithinWatermark(list(key)).drop("__salt")


def drift_counts(
    profile: DriftProfile, stream: DataFrame, ts: str, width: int, delay: str = "10 minutes"
) -> DataFrame:
    """(slot, feature, bucket, n) per tumbling window, binned with the stored edges."""
    rows = bucket_rows(stream.withWatermark(ts, delay), profile.edges, profile.categorical, [ts])
    return (
        rows.groupBy(F.window(ts, _seconds(width)).alias("w"), "feature", "bucket")
        .agg(F.count("*").alias("n"))
        .select(_slot(F.col("w")).alias("slot"), "feature", "bucket", "n")
    )


def write_drift(profile: DriftProfile, counts: DataFrame, path: str, checkpoint: str):
    """Score each closed window as it is emitted and store (slot, feature, psi, status).

    All buckets of a window leave the state in the same micro-batch, so a batch
    holds whole windows. Its folder is named by the batch id and replaced when the
    batch is retried.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        # scoring reads the counts twice; the state behind them is read once
        batch.persist()
        try:
            scored = psi_by_window(profile, batch, ["slot"])
            scored.withColumn("status", classify(F.col("psi"))).write.mode("overwrite").parquet(
                f"{path}/batch={batch_id}"
            )
        finally:
            batch.unpersist()

    return (
        counts.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
