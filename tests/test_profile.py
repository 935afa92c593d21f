import pytest
from pyspark.sql import functions as F

from adjudica.operators import profile


@pytest.fixture(scope="module")
def small(spark):
    rows = [(1.0, "a", 1), (2.0, "a", 0), (3.0, None, 1), (None, "b", 0), (10.0, "b", 1)]
    return spark.createDataFrame(rows, "x double, c string, y int")


def test_table_profile(small):
    row = profile.table_profile(small, ["x"]).first()
    assert (row["count"], row["mean"], row["min"], row["p50"], row["max"]) == (4, 4.0, 1.0, 2.5, 10.0)
    assert row["p25"] == 1.75 and row["std"] == pytest.approx(4.0824829)


def test_info_and_gaps(small):
    info = {r["column"]: (r.dtype, r.non_null) for r in profile.schema_info(small).collect()}
    assert info == {"x": ("double", 4), "c": ("string", 4), "y": ("int", 5)}
    gaps = [(r["column"], r.missing_pct) for r in profile.missing_report(small).collect()]
    assert gaps == [("c", 20.0), ("x", 20.0)]
    assert profile.missing_cells(small).first()[0] == 2


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert profile.missing_cells(df).first()[0] == 1


def test_shares_and_rates(small):
    shares = {r.value: r.share for r in profile.value_shares(small, "c").collect()}
    assert shares == {"a": 0.5, "b": 0.5}
    rates = [(r.value, r["mean"], r["count"]) for r in profile.rate_by_group(small, "c", "y").collect()]
    assert rates == [("a", 0.5, 2), ("b", 0.5, 2)]
    row = profile.rate_by_category(small, ["c"], "y").first()
    assert row.base_rate == 0.6 and row.rows == 2


def test_correlation_is_pairwise(spark, small):
    df = small.select("x", "y", F.when(F.col("x") < 5, F.col("y")).alias("z"))
    got = {r["column"]: r["corr"] for r in profile.correlation_ranking(df, ["x", "z"], "y").collect()}
    assert got["z"] == pytest.approx(1.0)


def test_histogram_integrates_to_one(small):
    rows = profile.class_histogram(small, ["x"], "y", bins=4).collect()
    for label in (0, 1):
        mine = [r for r in rows if r.label == label]
        assert sum(r.density * (r.high - r.low) for r in mine) == pytest.approx(1.0)
    ones = {r.bin: r.rows for r in rows if r.label == 1}
    assert ones == {0: 2, 1: 0, 2: 0, 3: 1}  # 1 and 3 | 10 in the closed last bin


def test_head(small):
    assert [r.x for r in profile.head(small.where("x > 0"), 2, ["x"]).collect()] == [1.0, 2.0]
