"""Daily quantile sketches: exact while small, within the stated rank error when large, profiles without the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from adjudica.operators import drift, sketches
from adjudica.operators.monitor import DAY


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    out = [(int(d) * DAY, float(v), float(w)) for d, v, w in zip(rng.integers(0, 12, 60_000), rng.lognormal(0, 2, 60_000), rng.integers(0, 40, 60_000))]
    out += [(0, None, 1.0), (0, float("nan"), None)]
    return spark.createDataFrame(out, "at long, a double, b double").select(F.timestamp_seconds("at").alias("ts"), "a", "b").persist()


def table_of(rows, folder, k=sketches.K):
    sketches.sketch_table(rows, "ts", ["a", "b"], k=k).write.parquet(str(folder))
    return rows.sparkSession.read.schema(sketches.SCHEMA).parquet(str(folder))


@pytest.mark.parametrize("k", [64, 512])
def test_ranks_are_within_the_error(rows, tmp_path, k):
    days = table_of(rows, tmp_path / "s", k)
    probs = [i / 20 for i in range(1, 20)]
    found = sketches.quantiles(sketches.merged(days, 2 * DAY, 9 * DAY), probs).where("feature = 'a'").collect()
    values = np.sort([r.a for r in rows.where(F.unix_timestamp("ts").between(2 * DAY, 9 * DAY) & F.col("a").isNotNull() & ~F.isnan("a")).select("a").collect()])
    assert all(r.rows == len(values) for r in found) and len(found) == 19
    off = [abs(np.searchsorted(values, r.value, "right") / len(values) - r.prob) for r in found]
    assert max(off) <= sketches.rank_error(k) + 1 / len(values)
    assert sketches.rank_error(512) < sketches.rank_error(64) < 0.06


def test_small_ranges_are_exact(rows, tmp_path):
    few = rows.where("a < 0.05")
    days = table_of(few, tmp_path / "s")
    values = np.sort([r.a for r in few.select("a").collect()])
    assert len(values) < sketches.K
    for r in sketches.quantiles(sketches.merged(days), [0.0, 0.25, 0.5, 1.0]).where("feature = 'a'").collect():
        assert r.value == values[max(int(np.ceil(round(r.prob * len(values), 7))) - 1, 0)]


def test_profile_of_days_scores_like_one_of_rows(rows, tmp_path):
    days = table_of(rows, tmp_path / "s")
    week = rows.where(F.unix_timestamp("ts") <= 6 * DAY)
    profile = sketches.profile_of(days, ["a", "b", "absent"], 0, 6 * DAY)
    assert profile.edges["absent"] is None and not profile.filled["absent"]
    shares = {(r.feature, r.bucket): r.share for r in profile.shares.collect()}
    assert sum(v for (f, _), v in shares.items() if f == "a") == pytest.approx(1.0)
    exact = {(r.feature, r.bucket): r.share for r in drift.bucket_shares(week.select("a", "b"), {c: profile.edges[c] for c in ("a", "b")}, []).collect()}
    assert set(exact) == set(shares)
    assert max(abs(exact[k] - shares[k]) for k in exact) <= 2 * sketches.rank_error()
    # left-closed buckets: the ties of b at an edge belong to the right
    moved = rows.where(F.unix_timestamp("ts") > 6 * DAY).select((F.col("a") * 3).alias("a"), "b")
    psi = {r.feature: r.psi for r in drift.psi_scores(profile, moved.withColumn("absent", F.lit(1.0))).collect()}
    assert psi["a"] > 0.2 and psi["b"] < 0.01


def test_empty_ranges(rows, tmp_path):
    days = table_of(rows, tmp_path / "s")
    assert sketches.merged(days, 100 * DAY, 101 * DAY).count() == 0
    assert sketches.profile_of(days, ["a"], 100 * DAY, 101 * DAY).edges == {"a": None}
