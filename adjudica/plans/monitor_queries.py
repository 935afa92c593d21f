"""Catalogue: windowed monitoring over the event table.

Roles: event_type is the decision / handler / error type, value the latency or
probability, user_id the instance; "error" events are failures, "purchase" approvals.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import monitor as m
from .registry import query, table

_SLOT = "(floor(epoch(ts))::BIGINT // {w}) * {w}"
VALUE_BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


def slot_sql(width: int) -> str:
    return _SLOT.format(w=width)


def events(spark, sf):
    return table(spark, sf, "events")


@query(
    "events_rate_by_type",
    f"""
    SELECT {slot_sql(3600)} AS slot, event_type, count(*) AS n, round(count(*) / 3600.0, 9) AS rate
    FROM events GROUP BY 1, 2
    """,
)
def events_rate_by_type(spark, sf):
    rates = m.counts_and_rates(events(spark, sf), "ts", m.HOUR, ["event_type"])
    return rates.withColumn("rate", F.round("rate", 9))


@query(
    "events_rate_total",
    f"SELECT {slot_sql(300)} AS slot, count(*) AS n, round(count(*) / 300.0, 9) AS rate FROM events GROUP BY 1",
)
def events_rate_total(spark, sf):
    return m.counts_and_rates(events(spark, sf), "ts", 300).withColumn("rate", F.round("rate", 9))


def _wide_sql(width: int, where: str = "true") -> str:
    les = ", ".join(f"count(*) FILTER (value <= {b}) AS le_{i}" for i, b in enumerate(VALUE_BOUNDS))
    return f"""wide AS (SELECT {slot_sql(width)} AS slot, {les}, count(value) AS n FROM events
      WHERE {where} GROUP BY 1)"""


def quantile_sql(q: float, n: str = "n") -> str:
    rank = f"({q} * {n})"
    cases = [f"WHEN le_0 >= {rank} THEN {VALUE_BOUNDS[0]} * {rank} / nullif(le_0, 0)"]
    for i in range(1, len(VALUE_BOUNDS)):
        lo, hi = VALUE_BOUNDS[i - 1], VALUE_BOUNDS[i]
        cases.append(
            f"WHEN le_{i} >= {rank} THEN {lo} + {hi - lo} * ({rank} - le_{i - 1}) / nullif(le_{i} - le_{i - 1}, 0)"
        )
    return f"CASE WHEN {n} > 0 THEN CASE {' '.join(cases)} ELSE {VALUE_BOUNDS[-1]} END END::DOUBLE"


@query(
    "events_histogram",
    f"""
    WITH {_wide_sql(86400)}
    SELECT slot, le, cumulative FROM (
      {' UNION ALL '.join(f"SELECT slot, '{b:g}' AS le, le_{i} AS cumulative FROM wide" for i, b in enumerate(VALUE_BOUNDS))}
      UNION ALL SELECT slot, '+Inf', n FROM wide)
    """,
)
def events_histogram(spark, sf):
    wide = m.histogram_wide(events(spark, sf), "value", VALUE_BOUNDS, "ts", m.DAY)
    return m.histogram_long(wide, VALUE_BOUNDS)


_QS = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


@query(
    "histogram_quantile",
    f"""
    WITH {_wide_sql(86400)}
    SELECT slot, {', '.join(f'round({quantile_sql(q)}, 6) AS {n}' for n, q in _QS.items())} FROM wide
    """,
)
def histogram_quantile(spark, sf):
    wide = m.histogram_wide(events(spark, sf), "value", VALUE_BOUNDS, "ts", m.DAY)
    quantiles = m.quantiles_of(wide, VALUE_BOUNDS, _QS)
    return quantiles.select("slot", *[F.round(n, 6).alias(n) for n in _QS])


def _ratio_sql(hit: str, step: int, width: int, where: str = "true") -> str:
    """CTEs ending in ratio_(slot, hits, total, ratio)."""
    floor = 0.001 * width
    return f"""
    part_ AS (SELECT {slot_sql(step)} AS slot, count(*) FILTER ({hit}) AS hits, count(*) AS total
      FROM events WHERE {where} GROUP BY 1),
    grid AS (SELECT unnest(range((SELECT min(slot) FROM part_), (SELECT max(slot) FROM part_) + 1, {step})) AS slot),
    sums AS (SELECT slot, (sum(coalesce(hits, 0)) OVER w)::BIGINT AS hits, (sum(coalesce(total, 0)) OVER w)::BIGINT AS total
      FROM grid LEFT JOIN part_ USING (slot)
      WINDOW w AS (ORDER BY slot RANGE BETWEEN {width - step} PRECEDING AND CURRENT ROW)),
    ratio_ AS (SELECT slot, hits, total, hits / greatest(total, {floor}::DOUBLE) AS ratio FROM sums)"""


@query(
    "error_ratio",
    f"WITH {_ratio_sql(chr(39).join(['event_type = ', 'error', '']), 3600, 6 * 3600)} "
    "SELECT slot, hits, total, round(ratio, 6) AS ratio FROM ratio_",
)
def error_ratio(spark, sf):
    out = m.trailing_ratio(
        events(spark, sf), "ts", F.col("event_type") == "error", m.HOUR, 6 * m.HOUR
    )
    return out.withColumn("ratio", F.round("ratio", 6))


_PURCHASE = "event_type = 'purchase'"


@query(
    "approval_rate_trailing",
    f"WITH {_ratio_sql(_PURCHASE, 60, 1800)} SELECT slot, hits, total, round(ratio, 6) AS ratio FROM ratio_",
)
def approval_rate_trailing(spark, sf):
    """30-minute share at every minute, idle minutes included."""
    out = m.trailing_ratio(
        events(spark, sf), "ts", F.col("event_type") == "purchase", m.MINUTE, 30 * m.MINUTE
    )
    return out.withColumn("ratio", F.round("ratio", 6))


@query(
    "last_hour_count",
    f"""
    WITH {_ratio_sql('true', 60, 3600)}
    SELECT slot, total AS n FROM ratio_
    """,
)
def last_hour_count(spark, sf):
    part = m.partials(events(spark, sf), "ts", m.MINUTE, {"n": F.count("*")})
    return m.trailing_sums(part, m.MINUTE, m.HOUR, [], ["n"])


@query(
    "trailing_quantiles",
    f"""
    WITH {_wide_sql(3600)},
    grid AS (SELECT unnest(range((SELECT min(slot) FROM wide), (SELECT max(slot) FROM wide) + 1, 3600)) AS slot),
    roll AS (SELECT slot, {', '.join(f'sum(coalesce(le_{i}, 0)) OVER w AS le_{i}' for i in range(len(VALUE_BOUNDS)))},
      sum(coalesce(n, 0)) OVER w AS n FROM grid LEFT JOIN wide USING (slot)
      WINDOW w AS (ORDER BY slot RANGE BETWEEN {5 * 3600} PRECEDING AND CURRENT ROW))
    SELECT slot, n::BIGINT AS "count", round({quantile_sql(0.95)}, 6) AS p95 FROM roll
    """,
)
def trailing_quantiles(spark, sf):
    out = m.trailing_quantiles(
        events(spark, sf), "ts", "value", VALUE_BOUNDS, {"p95": 0.95}, m.HOUR, 6 * m.HOUR
    )
    return out.withColumn("p95", F.round("p95", 6))


@query(
    "mean_batch_size",
    f"""
    WITH per AS (SELECT {slot_sql(3600)} AS slot, user_id, count(*) AS size FROM events GROUP BY 1, 2)
    SELECT slot, count(size) AS batches, sum(size)::BIGINT AS records,
      round(sum(size) / greatest(count(size), 3.6::DOUBLE), 6) AS mean_size FROM per GROUP BY 1
    """,
)
def mean_batch_size(spark, sf):
    """A user's events of one hour are a batch."""
    batches = (
        events(spark, sf)
        .groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz").alias("ts"), "user_id")
        .agg(F.count("*").alias("size"))
    )
    return m.mean_batch_size(batches, "ts", "size", m.HOUR).withColumn("mean_size", F.round("mean_size", 6))


@query(
    "last_gauge",
    """
    SELECT user_id, arg_max(value, (ts, event_id)) AS value, floor(epoch(max(ts)))::BIGINT AS seconds FROM events GROUP BY 1
    """,
)
def last_gauge(spark, sf):
    latest = m.last_gauge(events(spark, sf), "ts", "value", "user_id", tie="event_id")
    return latest.select("user_id", "value", m.epoch_seconds(latest, "ts").alias("seconds"))


@query(
    "gauge_overview",
    """
    WITH last_ AS (SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1)
    SELECT count(*) AS instances, round(sum(value), 2) AS total, max(value) AS highest,
      count(*) FILTER (value = 0) AS at_zero FROM last_
    """,
)
def gauge_overview(spark, sf):
    latest = m.last_gauge(events(spark, sf), "ts", "value", "user_id", tie="event_id")
    return m.gauge_overview(latest).withColumn("total", F.round("total", 2))


def _holds_sql(source: str, condition: str, duration: int, keys: str = "") -> str:
    """CTEs ending in fired(keys, slot, active_since)."""
    part = f"PARTITION BY {keys}" if keys else ""
    key = f"{keys}, " if keys else ""
    return f"""
    flag AS (SELECT *, coalesce({condition}, false) AS pending FROM {source}),
    isl AS (SELECT *, sum((NOT pending)::INT) OVER ({part} ORDER BY slot) AS island FROM flag),
    act AS (SELECT *, min(CASE WHEN pending THEN slot END) OVER (PARTITION BY {key} island) AS active_since FROM isl),
    fired AS (SELECT * FROM act WHERE pending AND slot - active_since >= {duration})"""


_EPISODE = """SELECT {k}active_since, min(slot) AS fired_at, max(slot) AS last_at, count(*) AS evaluations
    FROM fired GROUP BY ALL"""


@query(
    "alert_approval_band",
    f"WITH {_ratio_sql(_PURCHASE, 3600, 6 * 3600)}, "
    f"{_holds_sql('ratio_', 'ratio > 0.25 OR ratio < 0.15', 3 * 3600)} {_EPISODE.format(k='')}",
)
def alert_approval_band(spark, sf):
    """Approval share outside the band at three further hourly evaluations."""
    firing = m.approval_rate_alert(
        events(spark, sf), "ts", F.col("event_type") == "purchase", 0.15, 0.25, m.HOUR, 6 * m.HOUR, 3 * m.HOUR
    )
    return m.alert_intervals(firing)


@query(
    "alert_error_ratio",
    f"WITH {_ratio_sql(chr(39).join(['event_type = ', 'error', '']), 600, 3600)}, "
    f"{_holds_sql('ratio_', 'ratio > 0.25', 1200)} {_EPISODE.format(k='')}",
)
def alert_error_ratio(spark, sf):
    firing = m.error_ratio_alert(
        events(spark, sf), "ts", F.col("event_type") == "error", 0.25, 600, m.HOUR, 1200
    )
    return m.alert_intervals(firing)


@query(
    "alert_latency",
    f"""
    WITH {_wide_sql(3600)},
    grid AS (SELECT unnest(range((SELECT min(slot) FROM wide), (SELECT max(slot) FROM wide) + 1, 3600)) AS slot),
    roll AS (SELECT slot, {', '.join(f'sum(coalesce(le_{i}, 0)) OVER w AS le_{i}' for i in range(len(VALUE_BOUNDS)))},
      sum(coalesce(n, 0)) OVER w AS n FROM grid LEFT JOIN wide USING (slot)
      WINDOW w AS (ORDER BY slot RANGE BETWEEN {2 * 3600} PRECEDING AND CURRENT ROW)),
    q AS (SELECT slot, {quantile_sql(0.95)} AS quantile FROM roll),
    {_holds_sql('q', 'quantile > 150.5', 2 * 3600)} {_EPISODE.format(k='')}
    """,
)
def alert_latency(spark, sf):
    firing = m.latency_alert(
        events(spark, sf), "ts", "value", 150.5, 0.95, m.HOUR, 3 * m.HOUR, 2 * m.HOUR, VALUE_BOUNDS
    )
    return m.alert_intervals(firing)


@query(
    "alert_error_burst",
    f"""
    WITH part_ AS (SELECT event_type, {slot_sql(60)} AS slot, count(*) AS n FROM events GROUP BY 1, 2),
    grid AS (SELECT event_type, slot FROM (SELECT DISTINCT event_type FROM part_),
      unnest(range((SELECT min(slot) FROM part_), (SELECT max(slot) FROM part_) + 1, 60)) AS g(slot)),
    roll AS (SELECT event_type, slot, (sum(coalesce(n, 0)) OVER (PARTITION BY event_type ORDER BY slot
      RANGE BETWEEN 540 PRECEDING AND CURRENT ROW))::BIGINT AS errors FROM grid LEFT JOIN part_ USING (event_type, slot))
    SELECT event_type, slot, errors FROM roll WHERE errors > 3
    """,
)
def alert_error_burst(spark, sf):
    """More than three events of one type within ten minutes, no delay."""
    firing = m.error_burst_alert(events(spark, sf), "ts", "event_type", 3)
    return firing.where("firing").select("event_type", "slot", "errors")


@query(
    "no_traffic",
    f"""
    WITH src AS (SELECT *, user_id % 97 AS lane FROM events),
    part_ AS (SELECT lane, {slot_sql(3600)} AS slot, count(*) AS n FROM src GROUP BY 1, 2),
    grid AS (SELECT lane, slot FROM (SELECT DISTINCT lane FROM part_),
      unnest(range((SELECT min(slot) FROM part_), (SELECT max(slot) FROM part_) + 1, 3600)) AS g(slot)),
    roll AS (SELECT lane, slot, sum(coalesce(n, 0)) OVER (PARTITION BY lane ORDER BY slot
      RANGE BETWEEN 7200 PRECEDING AND CURRENT ROW) AS n FROM grid LEFT JOIN part_ USING (lane, slot)),
    {_holds_sql('roll', 'n = 0', 4 * 3600, 'lane')} {_EPISODE.format(k='lane, ')}
    """,
)
def no_traffic(spark, sf):
    """Groups of users without any event in the trailing three hours, for four hours."""
    lanes = events(spark, sf).withColumn("lane", F.col("user_id") % 97)
    firing = m.no_traffic_alert(lanes, "ts", m.HOUR, 3 * m.HOUR, 4 * m.HOUR, ["lane"])
    return m.alert_intervals(firing, ["lane"])


@query(
    "alert_gauge_down",
    f"""
    WITH src AS (SELECT user_id % 5 AS inst, ts, event_id, (event_type <> 'error')::INT AS up FROM events),
    part_ AS (SELECT inst, {slot_sql(3600)} AS slot, arg_max(up, (ts, event_id)) AS up FROM src GROUP BY 1, 2),
    grid AS (SELECT inst, slot FROM (SELECT DISTINCT inst FROM part_),
      unnest(range((SELECT min(slot) FROM part_), (SELECT max(slot) FROM part_) + 1, 3600)) AS g(slot)),
    roll AS (SELECT inst, slot, last_value(up IGNORE NULLS) OVER (PARTITION BY inst ORDER BY slot) AS up
      FROM grid LEFT JOIN part_ USING (inst, slot)),
    {_holds_sql('roll', 'up = 0', 2 * 3600, 'inst')} {_EPISODE.format(k='inst, ')}
    """,
)
def alert_gauge_down(spark, sf):
    """Instances whose last reading of the hour is 0 for two further hours."""
    readings = events(spark, sf).select(
        "event_id", (F.col("user_id") % 5).alias("inst"), "ts", (F.col("event_type") != "error").cast("int").alias("up")
    )
    firing = m.gauge_alert(readings, "ts", "up", "inst", 2 * m.HOUR, m.HOUR, tie="event_id")
    return m.alert_intervals(firing, ["inst"])


def _le_sql(value: str, bounds, width: int, source: str) -> str:
    les = ", ".join(f"count(*) FILTER ({value} <= {float(b)}) AS le_{i}" for i, b in enumerate(bounds))
    rows = " UNION ALL ".join(
        f"SELECT slot, '{float(b):g}' AS le, le_{i} AS cumulative FROM wide" for i, b in enumerate(bounds)
    )
    return f"""
    WITH wide AS (SELECT {slot_sql(width)} AS slot, {les}, count({value}) AS n FROM {source} GROUP BY 1)
    {rows} UNION ALL SELECT slot, '+Inf', n FROM wide"""


@query(
    "probability_heatmap",
    _le_sql("p", m.PROBABILITY_BOUNDS, 300, "(SELECT ts, least(value / 300, 1.0::DOUBLE) AS p FROM events)"),
)
def probability_heatmap(spark, sf):
    """Increase of every probability bucket per five minutes."""
    scored = events(spark, sf).select("ts", F.least(F.col("value") / 300, F.lit(1.0)).alias("p"))
    wide = m.histogram_wide(scored, "p", m.PROBABILITY_BOUNDS, "ts", 300)
    return m.histogram_long(wide, m.PROBABILITY_BOUNDS)


@query(
    "batch_size_histogram",
    _le_sql(
        "size",
        m.BATCH_BOUNDS,
        86400,
        "(SELECT date_trunc('hour', ts) AS ts, event_type, count(*) AS size FROM events GROUP BY 1, 2)",
    ),
)
def batch_size_histogram(spark, sf):
    """Records per request, a request being one event type within an hour."""
    batches = (
        events(spark, sf)
        .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "event_type")
        .agg(F.count("*").alias("size"))
    )
    wide = m.histogram_wide(batches, "size", m.BATCH_BOUNDS, "ts", m.DAY)
    return m.histogram_long(wide, m.BATCH_BOUNDS)


@query(
    "latency_histogram",
    _le_sql("s", m.LATENCY_BOUNDS, 3600, "(SELECT ts, value / 100 AS s FROM events)"),
)
def latency_histogram(spark, sf):
    wide = m.histogram_wide(
        events(spark, sf).select("ts", (F.col("value") / 100).alias("s")), "s", m.LATENCY_BOUNDS, "ts", m.HOUR
    )
    return m.histogram_long(wide, m.LATENCY_BOUNDS)


@query(
    "rate_by_status",
    f"""
    SELECT {slot_sql(300)} AS slot, event_type AS handler, CASE WHEN value > 150 THEN 500 ELSE 200 END AS status,
      count(*) AS n, round(count(*) / 300.0, 9) AS rate FROM events GROUP BY 1, 2, 3
    """,
)
def rate_by_status(spark, sf):
    """Request rate by handler and status."""
    status = F.when(F.col("value") > 150, 500).otherwise(200).alias("status")
    served = events(spark, sf).select("ts", F.col("event_type").alias("handler"), status)
    rates = m.counts_and_rates(served, "ts", 300, ["handler", "status"])
    return rates.withColumn("rate", F.round("rate", 9))
