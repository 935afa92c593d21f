import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adjudica.operators import quantiles
from conftest import DATA

PROBS = [i / 10 for i in range(11)]


@pytest.mark.parametrize("limit", [None, 700, 40])
def test_equals_builtin_percentile(spark, limit):
    df = spark.read.parquet(f"{DATA}/lineitem.parquet")
    columns = ["l_quantity", "l_extendedprice", "l_tax"]
    ours = quantiles.exact_quantiles(df, columns, PROBS, limit)
    builtin = df.agg(*[F.percentile(c, PROBS).alias(c) for c in columns]).first()
    assert ours == {c: list(builtin[c]) for c in columns}


def test_narrowing_handles_a_value_that_fills_most_of_the_table(spark):
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 != 0, F.lit(7.0)).otherwise(F.col("id") / 1000.0).alias("v")
    )
    ours = quantiles.exact_quantiles(hot, ["v"], PROBS, 100)["v"]
    assert ours == list(hot.agg(F.percentile("v", PROBS)).first()[0])


def test_heavy_tail_and_infinities_fall_back_to_a_sketch(spark, monkeypatch):
    tails = spark.range(3000).select(F.exp(F.col("id") / 5.0).alias("v"))
    ours = quantiles.exact_quantiles(tails, ["v"], PROBS, 30)["v"]
    assert ours == list(tails.agg(F.percentile("v", PROBS)).first()[0])
    probs = [0.25, 0.5, 0.75]
    open_ended = spark.range(1000).select(
        F.when(F.col("id") < 10, -math.inf).when(F.col("id") > 990, math.inf).otherwise(F.col("id") / 3).alias("v")
    )
    ours = quantiles.exact_quantiles(open_ended, ["v"], probs, 30)["v"]
    assert ours == list(open_ended.agg(F.percentile("v", probs)).first()[0])


def test_partitioning_does_not_matter(spark):
    df = spark.read.parquet(f"{DATA}/orders.parquet").select("o_totalprice")
    results = [
        quantiles.exact_quantiles(df.repartition(n), ["o_totalprice"], PROBS, 200) for n in (1, 17)
    ]
    assert results[0] == results[1]


def test_text_gaps_and_empty_columns(spark):
    df = spark.createDataFrame(
        [("1", None), ("2", None), ("3", None), ("x", None), ("10", None), (None, None)],
        "a string, b double",
    )
    assert quantiles.exact_medians(df, ["a", "b"]) == {"a": 2.5, "b": None}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_subnormal=False), min_size=1, max_size=60))
def test_any_list(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ours = quantiles.exact_quantiles(df, ["v"], [0.25, 0.5, 0.9])["v"]
    expected = list(df.agg(F.percentile("v", [0.25, 0.5, 0.9])).first()[0])
    assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for a, b in zip(ours, expected))
