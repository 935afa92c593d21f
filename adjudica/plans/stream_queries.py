"""Catalogue: Structured Streaming forms. Each runs over all events as a file stream;
the SQL gives the rows of the windows the final watermark has closed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift
from ..operators import monitor as batch
from ..session import work_dir
from ..streaming import alerts, monitor, runs
from . import drift_queries
from .drift_queries import events_profile
from .monitor_queries import VALUE_BOUNDS, quantile_sql, slot_sql
from .registry import query, table

_DELAY = "1 hour"
ALERT_PARTITIONS = 8  # one state record per series: a handful
_CLOSED = "(SELECT epoch(max(ts)) - 3600 FROM events)"


def event_stream(spark, sf):
    return runs.event_time(runs.file_stream(spark, sf, "events.parquet"), "ts")


@query(
    "stream_rates",
    f"""
    SELECT * FROM (SELECT {slot_sql(3600)} AS slot, event_type, count(*) AS n, round(count(*) / 3600.0, 9) AS rate
      FROM events GROUP BY 1, 2) WHERE slot + 3600 <= {_CLOSED}
    """,
)
def stream_rates(spark, sf):
    counted = monitor.counts_and_rates(event_stream(spark, sf), "ts", batch.HOUR, ["event_type"], _DELAY)
    return runs.run_to_table(counted, "stream-rates").withColumn("rate", F.round("rate", 9))


_LE = ", ".join(f"count(*) FILTER (value <= {b}) AS le_{i}" for i, b in enumerate(VALUE_BOUNDS))


@query(
    "stream_quantiles",
    f"""
    WITH wide AS (SELECT {slot_sql(86400)} AS slot, {_LE}, count(value) AS n FROM events GROUP BY 1)
    SELECT slot, n AS "count", round({quantile_sql(0.95)}, 6) AS p95 FROM wide WHERE slot + 86400 <= {_CLOSED}
    """,
)
def stream_quantiles(spark, sf):
    wide = monitor.histogram(event_stream(spark, sf), "ts", "value", VALUE_BOUNDS, batch.DAY, _DELAY)
    stored = runs.run_to_table(wide, "stream-histogram")
    return batch.quantiles_of(stored, VALUE_BOUNDS, {"p95": 0.95}).select(
        "slot", "count", F.round("p95", 6).alias("p95")
    )


@query(
    "stream_dedupe",
    "SELECT event_id, user_id, event_type, epoch_us(ts) AS at FROM events",
)
def stream_dedupe(spark, sf):
    """Every event delivered three times, kept once."""
    stream = event_stream(spark, sf).select("event_id", "user_id", "event_type", "ts")
    thrice = stream.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("copy")
    kept = runs.run_to_table(monitor.dedupe(thrice, ["event_id"], "ts", "60 days"), "stream-dedupe")
    return kept.select("event_id", "user_id", "event_type", F.unix_micros("ts").alias("at"))


def _trailing_sql(hit: str = "event_type = 'purchase'", where: str = "total > 0 AND") -> str:
    return f"""
    part_ AS (SELECT {slot_sql(600)} AS slot, count(*) FILTER ({hit}) AS hits, count(*) AS total
      FROM events GROUP BY 1),
    grid AS (SELECT unnest(range((SELECT min(slot) FROM part_), (SELECT max(slot) FROM part_) + 1, 600)) AS slot),
    sums AS (SELECT slot, coalesce(sum(hits) OVER w, 0)::BIGINT AS hits, coalesce(sum(total) OVER w, 0)::BIGINT AS total
      FROM grid LEFT JOIN part_ USING (slot)
      WINDOW w AS (ORDER BY slot RANGE BETWEEN 3000 PRECEDING AND CURRENT ROW)),
    ratio_ AS (SELECT slot, hits, total, hits / greatest(total, 3.6::DOUBLE) AS ratio FROM sums
      WHERE {where} slot + 600 <= {_CLOSED})"""


def _episodes_sql(source: str, condition: str, step: int, duration: int) -> str:
    """Episodes over the evaluations there are: a missing one ends an episode."""
    return f"""
    flag AS (SELECT slot, coalesce({condition}, false) AS pending FROM {source}),
    isl AS (SELECT *, sum((NOT pending)::INT) OVER (ORDER BY slot) AS island,
      sum(CASE WHEN slot - prev <= {step} OR prev IS NULL THEN 0 ELSE 1 END) OVER (ORDER BY slot) AS gap
      FROM (SELECT *, lag(slot) OVER (ORDER BY slot) AS prev FROM flag)),
    act AS (SELECT *, min(CASE WHEN pending THEN slot END) OVER (PARTITION BY island, gap) AS since FROM isl)
    SELECT 'all' AS series, since AS active_since, min(slot) AS fired_at FROM act
    WHERE pending AND slot - since >= {duration} GROUP BY since"""


def trailing_share(spark, sf, event_type="purchase", timed=False):
    return monitor.trailing_ratio(
        event_stream(spark, sf), "ts", F.col("event_type") == event_type, 600, 3600, (), _DELAY, timed
    )


def _fired(evaluations, pending, step, duration, keys=(), idle_pending=False):
    """Windows and alerts in one streaming query: the watermark goes on through ``at``."""
    flagged = evaluations.select(*keys, "slot", "at", F.coalesce(pending, F.lit(False)).alias("pending"))
    firing = alerts.duration_alerts(flagged, list(keys), step, duration, idle_pending, event_time="at")
    return runs.run_to_table(firing, "stream-alert", ALERT_PARTITIONS).drop("late")


@query(
    "stream_approval_rate",
    f"WITH {_trailing_sql()} SELECT slot, hits, total, round(ratio, 6) AS ratio FROM ratio_",
)
def stream_approval_rate(spark, sf):
    """Trailing hour at every ten minutes, from ten-minute partials."""
    out = runs.run_to_table(trailing_share(spark, sf), "stream-ratio")
    return out.withColumn("ratio", F.round("ratio", 6))


@query("stream_alert_approval", f"WITH {_trailing_sql()}, {_episodes_sql('ratio_', 'ratio > 0.3', 600, 1800)}")
def stream_alert_approval(spark, sf):
    """Share above the limit for half an hour."""
    return _fired(trailing_share(spark, sf, timed=True), F.col("ratio") > 0.3, 600, 1800)


@query("stream_alert_collapse", f"WITH {_trailing_sql(where='')}, {_episodes_sql('ratio_', 'ratio < 0.1', 600, 1200)}")
def stream_alert_collapse(spark, sf):
    """Share below the limit for twenty minutes; a window without events has the share 0, as in the batch form."""
    return _fired(trailing_share(spark, sf, timed=True), F.col("ratio") < 0.1, 600, 1200, idle_pending=True)


_ERROR = "event_type = 'error'"


@query("stream_alert_error_ratio", f"WITH {_trailing_sql(_ERROR)}, {_episodes_sql('ratio_', 'ratio > 0.25', 600, 1200)}")
def stream_alert_error_ratio(spark, sf):
    """Share of failures above the limit for twenty minutes."""
    return _fired(trailing_share(spark, sf, "error", True), F.col("ratio") > 0.25, 600, 1200)


@query(
    "stream_alert_latency",
    f"""
    WITH part_ AS (SELECT {slot_sql(3600)} AS slot, {_LE}, count(value) AS n FROM events GROUP BY 1),
    grid AS (SELECT unnest(range((SELECT min(slot) FROM part_), (SELECT max(slot) FROM part_) + 1, 3600)) AS slot),
    sums AS (SELECT slot, {', '.join(f'sum(le_{i}) OVER w AS le_{i}' for i in range(len(VALUE_BOUNDS)))},
      sum(n) OVER w AS n FROM grid LEFT JOIN part_ USING (slot)
      WINDOW w AS (ORDER BY slot RANGE BETWEEN 7200 PRECEDING AND CURRENT ROW)),
    late AS (SELECT slot, {quantile_sql(0.95)} AS quantile FROM sums WHERE n > 0 AND slot + 3600 <= {_CLOSED}),
    {_episodes_sql('late', 'quantile > 150.5', 3600, 7200)}
    """,
)
def stream_alert_latency(spark, sf):
    """Quantile of the trailing three hours above the limit for two hours."""
    sums = {k: v for k, v in batch.histogram_aggregates("value", VALUE_BOUNDS).items() if k != "sum"}
    wide = monitor.trailing(event_stream(spark, sf), "ts", batch.HOUR, 3 * batch.HOUR, sums, (), _DELAY, True)
    limit = batch.histogram_quantile(0.95, VALUE_BOUNDS) > 150.5
    return _fired(wide, limit, batch.HOUR, 2 * batch.HOUR)


@query(
    "stream_alert_burst",
    f"""
    WITH part_ AS (SELECT event_type, {slot_sql(60)} AS slot, count(*) AS n FROM events GROUP BY 1, 2),
    grid AS (SELECT event_type, slot FROM (SELECT DISTINCT event_type FROM part_),
      unnest(range((SELECT min(slot) FROM part_), (SELECT max(slot) FROM part_) + 600, 60)) AS g(slot)),
    roll AS (SELECT event_type, slot, sum(n) OVER (PARTITION BY event_type ORDER BY slot
      RANGE BETWEEN 540 PRECEDING AND CURRENT ROW) AS errors FROM grid LEFT JOIN part_ USING (event_type, slot)),
    flag AS (SELECT event_type, slot, errors > 3 AS pending,
      coalesce(lag(errors) OVER (PARTITION BY event_type ORDER BY slot), 0) > 3 AS held FROM roll
      WHERE slot + 60 <= {_CLOSED})
    SELECT event_type, slot AS active_since, slot AS fired_at FROM flag WHERE pending AND NOT held
    """,
)
def stream_alert_burst(spark, sf):
    """More than three events of one type within ten minutes, at once, per type."""
    counted = monitor.trailing(
        event_stream(spark, sf), "ts", 60, 600, {"errors": F.count("*")}, ["event_type"], _DELAY, True
    )
    return _fired(counted, F.col("errors") > 3, 60, 0, ["event_type"])


_BEAT_END = "(SELECT epoch(max(ts)) + 3 * 86400 - 3600 FROM events)"


@query(
    "stream_no_traffic",
    f"""
    WITH src AS (SELECT user_id % 97 AS lane, {slot_sql(3600)} AS slot FROM events),
    seen AS (SELECT DISTINCT lane, slot FROM src),
    nxt AS (SELECT lane, slot, lead(slot) OVER (PARTITION BY lane ORDER BY slot) AS nx FROM seen)
    SELECT lane, slot + 3600 AS active_since, slot + 3600 + 14400 AS fired_at
    FROM nxt WHERE coalesce(nx - 3600, {_BEAT_END} - 3600) >= slot + 3600 + 14400
    """,
)
def stream_no_traffic(spark, sf):
    """Groups of users without an event for four hours; a clock that goes on for three days after
    the last event shows the silence that no event ends."""
    stream = event_stream(spark, sf).withColumn("lane", F.col("user_id") % 97)
    clock = work_dir(spark, "stream-clock")
    last = runs.event_time(table(spark, sf, "events").agg(F.max("ts").alias("ts")), "ts")
    last.select(F.explode(F.sequence("ts", F.col("ts") + F.expr("INTERVAL 3 DAYS"), F.expr("INTERVAL 1 HOUR"))).alias("ts")).write.parquet(clock)
    beats = spark.readStream.schema("ts timestamp").parquet(clock)
    marked = alerts.with_heartbeat(stream, beats, "ts", _DELAY)
    counted = monitor.windowed(marked, "ts", batch.HOUR, {"n": F.count("*")}, ["lane"], None, timed=True)
    flagged = counted.select("lane", "slot", "at", F.lit(False).alias("pending"))
    silent = alerts.duration_alerts(flagged, ["lane"], batch.HOUR, 4 * batch.HOUR, True, event_time="at")
    return runs.run_to_table(silent, "stream-silence", ALERT_PARTITIONS).drop("late")


def _gauge_sql(duration: int, expired: str) -> str:
    """Last reading of each hour carried forward, over the hours that the watermark has closed."""
    return f"""
    WITH src AS (SELECT user_id % 25 AS inst, ts, event_id, (event_type <> 'error')::INT AS up FROM events),
    part_ AS (SELECT inst, {slot_sql(3600)} AS slot, arg_max(up, (ts, event_id)) AS up FROM src GROUP BY 1, 2),
    grid AS (SELECT inst, unnest(range(min(slot), {_CLOSED}::BIGINT - 3600 + 1, 3600)) AS slot FROM part_ GROUP BY inst),
    roll AS (SELECT inst, slot, last_value(up IGNORE NULLS) OVER w AS up,
      slot - last_value(CASE WHEN up IS NOT NULL THEN slot END IGNORE NULLS) OVER w AS age
      FROM grid LEFT JOIN part_ USING (inst, slot) WINDOW w AS (PARTITION BY inst ORDER BY slot)),
    flag AS (SELECT inst, slot, up = 0 OR {expired} AS pending FROM roll),
    isl AS (SELECT *, sum((NOT pending)::INT) OVER (PARTITION BY inst ORDER BY slot) AS island FROM flag),
    act AS (SELECT *, min(CASE WHEN pending THEN slot END) OVER (PARTITION BY inst, island) AS since FROM isl)
    SELECT inst, since AS active_since, min(slot) AS fired_at FROM act
    WHERE pending AND slot - since >= {duration} GROUP BY inst, since"""


def _gauge_stream(spark, sf):
    return event_stream(spark, sf).select(
        "event_id", (F.col("user_id") % 25).alias("inst"), "ts", (F.col("event_type") != "error").cast("int").alias("up")
    )


@query("stream_alert_down", _gauge_sql(7200, "age > 3 * 3600"))
def stream_alert_down(spark, sf):
    """Instances that read 0, or gave no reading for three hours, for two further hours."""
    firing = alerts.gauge_alerts(
        _gauge_stream(spark, sf), "ts", "up", "inst", 2 * batch.HOUR, batch.HOUR, expiry=3 * batch.HOUR, tie="event_id", delay=_DELAY
    )
    return runs.run_to_table(firing, "stream-down", ALERT_PARTITIONS).drop("late")


@query("stream_alert_unloaded", _gauge_sql(3600, "false"))
def stream_alert_unloaded(spark, sf):
    """Instances whose last reading is 0 for an hour, however old it is."""
    firing = alerts.gauge_alerts(_gauge_stream(spark, sf), "ts", "up", "inst", batch.HOUR, batch.HOUR, tie="event_id", delay=_DELAY)
    return runs.run_to_table(firing, "stream-unloaded", ALERT_PARTITIONS).drop("late")


@query("stream_drift", drift_queries._BY_DAY.replace("FROM full_ GROUP BY", f"FROM full_ WHERE slot + 86400 <= {_CLOSED} GROUP BY"))
def stream_drift(spark, sf):
    """Each closed day scored against the stored profile as it leaves the window."""
    path = work_dir(spark, "drift-profile")
    events_profile(spark, sf).save(path)
    profile = drift.DriftProfile.load(spark, path)
    counts = monitor.drift_counts(profile, event_stream(spark, sf), "ts", batch.DAY, _DELAY)
    root = work_dir(spark, "stream-drift")
    with runs.stream_settings(spark):
        started = monitor.write_drift(profile, counts, f"{root}/out", f"{root}/state")
    started.awaitTermination()
    stored = spark.read.schema("slot long, feature string, psi double, status string").parquet(f"{root}/out")
    return stored.select("slot", "feature", F.round("psi", 5).alias("psi"), "status")
