import datetime as dt

import pytest
from pyspark.sql import functions as F

from adjudica.operators import monitor as m

START = dt.datetime(2024, 1, 1)
T0 = 1704067200


def events(spark, minutes, schema_extra=()):
    """(minute, *extra) tuples as events."""
    rows = [(START + dt.timedelta(minutes=r[0]), *r[1:]) for r in minutes]
    return spark.createDataFrame(rows, ", ".join(["ts timestamp_ntz", *schema_extra]))


def episodes(firing, keys=()):
    return [tuple(r) for r in m.alert_intervals(firing, keys).orderBy("active_since").collect()]


def decisions(spark, minutes, approved):
    return events(spark, [(i, approved(i)) for i in range(minutes)], ["ok boolean"])


def spike(spark, minutes_above):
    # 30-minute window: the share passes 0.9 once enough of the window is approved
    df = decisions(spark, 60 + minutes_above, lambda i: i >= 28)
    return m.approval_rate_alert(df, "ts", F.col("ok"), low=None, high=0.90)


def test_approval_spike_needs_fifteen_minutes(spark):
    full = spike(spark, 60)
    first = full.where("pending").agg(F.min("slot")).first()[0]
    fired = full.where("firing").agg(F.min("slot")).first()[0]
    assert fired - first == 15 * 60
    assert spike(spark, 8).where("firing").count() == 0


def test_collapse_also_fires_when_idle_unless_events_are_demanded(spark):
    df = events(spark, [(0, True), (200, True)], ["ok boolean"])
    assert m.approval_rate_alert(df, "ts", F.col("ok"), 0.2, None).where("firing").count() > 0
    assert m.approval_rate_alert(df, "ts", F.col("ok"), 0.2, None, min_events=1).where("firing").count() == 0


def test_no_traffic(spark):
    gap = m.no_traffic_alert(events(spark, [(0,), (1,), (50,), (51,)]), "ts")
    # the window empties at minute 16 and the alert needs 15 more minutes
    assert episodes(gap) == [(T0 + 16 * 60, T0 + 31 * 60, T0 + 49 * 60, 19)]
    assert m.no_traffic_alert(events(spark, [(0,), (29,)]), "ts").where("firing").count() == 0


def test_error_burst(spark):
    six = [(i, "ValueError") for i in range(6)]
    hot = m.error_burst_alert(events(spark, [*six, (40, "KeyError")], ["e string"]), "ts", "e")
    assert hot.where("firing").select("e").distinct().collect()[0].e == "ValueError"
    assert m.error_burst_alert(events(spark, six[:5], ["e string"]), "ts", "e").where("firing").count() == 0


def test_latency_alert(spark):
    slow = events(spark, [(i, 0.9) for i in range(20)], ["s double"])
    assert episodes(m.latency_alert(slow, "ts", "s"))[0][1] - T0 == 5 * 60
    assert m.latency_alert(slow.withColumn("s", F.lit(0.3)), "ts", "s").where("firing").count() == 0


def test_error_ratio_alert(spark):
    df = events(spark, [(i, 500 if i % 3 == 0 else 200) for i in range(30)], ["status int"])
    assert m.error_ratio_alert(df, "ts", F.col("status") >= 500).where("firing").count() > 0
    fine = df.withColumn("status", F.lit(200))
    assert m.error_ratio_alert(fine, "ts", F.col("status") >= 500).where("pending").count() == 0


def test_gauge_down(spark):
    rows = [(0, "a", 1.0), (1, "a", 0.0), (5, "a", 1.0), (0, "b", 0.0), (1, "b", 1.0), (6, "b", 1.0)]
    df = events(spark, rows, ["inst string", "up double"])
    firing = m.gauge_alert(df, "ts", "up", "inst", 120)
    assert episodes(firing, ["inst"]) == [("a", T0 + 60, T0 + 180, T0 + 240, 2)]
    overview = m.gauge_overview(m.last_gauge(df, "ts", "up", "inst")).first()
    assert (overview.instances, overview.total, overview.at_zero) == (2, 2.0, 0)


def quantile(spark, values, bounds, q):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return m.histogram_wide(df, "v", bounds).select(m.histogram_quantile(q, bounds).alias("q")).first().q


@pytest.mark.parametrize(
    "values, bounds, q, expected",
    [
        ([0.5, 1.5, 1.5, 1.5], (1, 2, 4), 0.5, 1 + 1 / 3),  # rank 2: one third into (1, 2]
        ([9.0, 9.0], (1, 2, 4), 0.5, 4.0),  # beyond the last bound
        ([1.0, 1.0], (1, 2), 0.5, 0.5),  # right-closed, first bucket starts at 0
        ([0.0, 0.0, 0.5], (0.0, 1.0), 0.5, 0.0),  # a first bound of 0 is returned as is
        ([], (1, 2), 0.5, None),
    ],
)
def test_histogram_quantile(spark, values, bounds, q, expected):
    got = quantile(spark, values, bounds, q)
    assert got is None if expected is None else got == pytest.approx(expected)


def test_mean_batch_size_guard(spark):
    df = events(spark, [(0, 10), (0, 30)], ["n int"])
    # two batches in an hour are below 0.001 per second: the guard is 3.6 batches
    assert m.mean_batch_size(df, "ts", "n", 3600).first().mean_size == pytest.approx(40 / 3.6)


def test_results_do_not_depend_on_partitioning(spark):
    df = decisions(spark, 200, lambda i: i % 3 == 0)
    ratios = [
        m.trailing_ratio(df.repartition(n), "ts", F.col("ok"), 60, 1800).orderBy("slot").collect() for n in (1, 17)
    ]
    assert ratios[0] == ratios[1]


def test_a_stray_timestamp_does_not_stretch_an_alert(spark):
    start = 1_704_067_200
    rows = [(start + 60 * i, "Approved") for i in range(600)] + [(start - 10 * 365 * 86400, "Approved")]
    df = spark.createDataFrame(rows, "at long, decision string").select(F.timestamp_seconds("at").alias("ts"), "decision")
    approved = F.col("decision") == "Approved"
    found = m.approval_rate_alert(df, "ts", approved, interval=(start, start + 600 * 60 - 60))
    assert found.count() == 600
    assert m.gauge_alert(
        df.withColumn("v", F.lit(1.0)).withColumn("i", F.lit("x")), "ts", "v", "i", 120, interval=(start, start + 5940)
    ).count() == 100
