"""Duration alerts on a stream: a condition that holds at every evaluation for a
while, silence, and gauges that read badly or not at all. One small state record per series.

Evaluations arrive as (series..., slot, pending). Slots missing between two
evaluations had no events at all; ``idle_pending`` says whether the condition
counts as true there (no traffic, a share that fell to zero) or false. A gauge keeps its last
reading in such slots, and counts as true once that is older than ``expiry``. Idle slots are a time spine without rows: they are
judged when the next evaluation comes, or by a timer when the watermark reaches the slot that makes the alert due.

With ``event_time``, a column that carries the watermark of the windows above, evaluations and alerts are one streaming query. The watermark is
that of all series together: one that falls silent is judged as long as others speak. If all may fall silent, ``with_heartbeat`` adds a clock.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .monitor import windowed

_STATE = StructType(
    [
        StructField("since", LongType()),  # first slot of the running episode, or null
        StructField("last", LongType()),  # latest slot seen
        StructField("fired", BooleanType()),
        StructField("held", BooleanType()),  # the latest evaluation
    ]
)
_EPISODE = [StructField("active_since", LongType()), StructField("fired_at", LongType()), StructField("late", LongType())]


class _Episode:
    """Folds evaluations, in slot order, into firing times."""

    def __init__(self, step: int, duration: int, idle_pending: bool, state=None):
        self.step, self.duration, self.idle = step, duration, idle_pending
        self.since, self.last, self.fired, self.held = state if state else (None, None, False, False)
        self.late = 0  # evaluations of this batch that came behind a later one

    def state(self) -> tuple:
        return self.since, self.last, self.fired, self.held

    def idle_from(self) -> int | None:
        """Since when the condition would hold if no evaluation came any more, or None."""
        if not self.idle or self.last is None:
            return None
        return self.since if self.since is not None else self.last + self.step

    def _hold(self, upto: int) -> list[tuple[int, int]]:
        """The condition held up to and including this slot."""
        due = self.since + self.duration
        if not self.fired and upto >= due:
            self.fired = True
            # the first evaluation at or after the due time
            steps = -(-(due - self.since) // self.step)
            return [(self.since, self.since + steps * self.step)]
        return []

    def idle_until(self, slot: int) -> list[tuple[int, int]]:
        """Account for missing slots after the last one, up to ``slot`` inclusive."""
        if self.last is None or slot <= self.last:
            return []
        since = self.idle_from()
        if since is None:
            self.since, self.fired = None, False
            return []
        if since > slot:
            return []
        self.since = since
        return self._hold(slot)

    def see(self, slot: int, pending: bool) -> list[tuple[int, int]]:
        out = self.idle_until(slot - self.step) if self.last is not None else []
        if self.last is not None and slot <= self.last:
            self.late += 1
            return out
        if pending:
            if self.since is None:
                self.since = slot
            out += self._hold(slot)
        else:
            self.since, self.fired = None, False
        self.last, self.held = slot, pending
        return out


class _Gauge(_Episode):
    """The reading of a slot without one is the last, until it is older than ``expiry``; then it is missing, which counts
    as true. Without ``expiry`` it never is."""

    def __init__(self, step: int, duration: int, expiry: int | None, state=None):
        super().__init__(step, duration, False, state)
        self.expiry = expiry

    def idle_from(self) -> int | None:
        if self.last is None:
            return None
        if self.held:
            return self.since
        return None if self.expiry is None else self.last + (self.expiry // self.step + 1) * self.step


class DurationAlert(StatefulProcessor):
    """Emits (key columns, active_since, fired_at, late) once per episode. Evaluations that come
    behind a later one of their series cannot change it any more: they give a row of
    their own with their number in ``late`` and no episode."""

    def __init__(
        self, step: int, duration: int, idle_pending: bool = False, keys: Sequence[str] = (), gauge: bool = False, expiry: int | None = None
    ):
        self.step, self.duration, self.idle, self.keys = step, duration, idle_pending, list(keys)
        self.gauge, self.expiry = gauge, expiry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("episode", _STATE)

    def _load(self) -> _Episode:
        found = self.state.get() if self.state.exists() else None
        held = tuple(found) if found else None
        if self.gauge:
            return _Gauge(self.step, self.duration, self.expiry, held)
        return _Episode(self.step, self.duration, self.idle, held)

    def _store(self, e: _Episode) -> None:
        self.state.update(e.state())
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        since = e.idle_from()
        if since is not None and not (e.fired and since == e.since):
            # silence is judged when the watermark reaches the slot that makes it due
            steps = -(-self.duration // self.step)
            self.handle.registerTimer((since + (steps + 1) * self.step) * 1000)

    def _emit(self, key, hits, late: int = 0) -> Iterator[pd.DataFrame]:
        rows = [(since, at, 0) for since, at in hits] + ([(None, None, late)] if late else [])
        if rows:
            out = {k: [v] * len(rows) for k, v in zip(self.keys, key)}
            for i, name in enumerate(("active_since", "fired_at", "late")):
                out[name] = pd.array([r[i] for r in rows], "Int64")
            yield pd.DataFrame(out)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        episode, hits = self._load(), []
        # one row per slot of one series in this micro-batch
        seen = pd.concat(list(rows)).sort_values("slot")
        for slot, pending in zip(seen["slot"], seen["pending"]):
            hits += episode.see(int(slot), bool(pending))
        self._store(episode)
        yield from self._emit(key, hits, episode.late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        episode = self._load()
        at = expiredTimerInfo.getExpiryTimeInMs() // 1000 - self.step
        hits = episode.idle_until(at)
        self.state.update(episode.state())
        yield from self._emit(key, hits)

    def close(self) -> None:
        pass


def with_heartbeat(stream: DataFrame, beats: DataFrame, ts: str, delay: str) -> DataFrame:
    """The stream, with a watermark that the times of ``beats`` (a column ``ts``) move on too.

    Beats are dropped behind the watermark. Their times must not run ahead of the clock of the
    events by more than ``delay``, or rows that come in time would count as late.
    """
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields if f.name != ts]
    both = stream.withColumn("__beat", F.lit(False)).unionByName(beats.select(ts, *empty, F.lit(True).alias("__beat")))
    # the filter names the time, so that it stays above the watermark
    real = F.when(F.col(ts).isNotNull(), ~F.col("__beat")).otherwise(False)
    return both.withWatermark(ts, delay).where(real).drop("__beat")


def duration_alerts(
    evaluations: DataFrame,
    series: Sequence[str],
    step: int,
    duration: int,
    idle_pending: bool = False,
    delay: str = "0 seconds",
    event_time: str | None = None,
    gauge: bool = False,
    expiry: int | None = None,
) -> DataFrame:
    """(series..., active_since, fired_at, late) of a stream of (series..., slot, pending).

    The key columns keep their names and types. Without a series all rows are one,
    named ``series`` = "all". ``event_time`` names the column that carries the evaluations' watermark; without
    it the slot does, with ``delay``.
    """
    keys = list(series) or ["series"]
    named = evaluations if series else evaluations.withColumn("series", F.lit("all"))
    columns = [*keys, F.col("slot").cast("long").alias("slot"), "pending"]
    if event_time:
        timed = named.select(*columns, F.col(event_time).alias("__at"))
    else:
        timed = named.select(*columns, F.timestamp_seconds(F.col("slot")).alias("__at")).withWatermark("__at", delay)
    return timed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=DurationAlert(step, duration, idle_pending, keys, gauge, expiry),
        outputStructType=StructType([*[timed.schema[k] for k in keys], *_EPISODE]),
        outputMode="Append",
        timeMode="EventTime",
    )


def gauge_alerts(
    readings: DataFrame,
    ts: str,
    value: str,
    instance: str,
    duration: int,
    step: int,
    equals: float = 0.0,
    expiry: int | None = None,
    tie: str | None = None,
    delay: str = "10 minutes",
) -> DataFrame:
    """The batch ``gauge_alert`` on a stream: an instance reads ``equals`` for the duration, or gave no reading for longer than
    ``expiry`` seconds, which the batch form cannot see at the end of its data. One streaming query."""
    order = F.struct(F.col(ts), F.col(tie or value))
    last = windowed(readings, ts, step, {"reading": F.max_by(value, order)}, [instance], delay, timed=True)
    flagged = last.select(instance, "slot", "at", F.coalesce(F.col("reading") == equals, F.lit(False)).alias("pending"))
    return duration_alerts(flagged, [instance], step, duration, event_time="at", gauge=True, expiry=expiry)
