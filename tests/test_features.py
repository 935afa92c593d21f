import math

import pytest
from pyspark.sql import functions as F

from adjudica.functions import clip, cut_at_marker, percent, to_number
from adjudica.operators import features, labels, rewrite

SCHEMA = "ApplicantIncome double, CoapplicantIncome double, LoanAmount double, Loan_Amount_Term double"


def one(spark, *row, fill="batch"):
    df = spark.createDataFrame([tuple(None if v is None else float(v) for v in row)], SCHEMA)
    return features.add_engineered_features(df, fill=fill).first()


def test_totals(spark):
    row = one(spark, 5000, 2000, 100, 360)
    assert row.TotalIncome == 7000 and math.isclose(row.LogTotalIncome, math.log(7001))


def test_instalment_and_ratio(spark):
    row = one(spark, 10000, 0, 120, 120)
    assert row.LoanAmountPerMonth == 1000 and math.isclose(row.DebtToIncomeRatio, 0.1)
    assert math.isclose(row.IncomeToLoanRatio, 10000 / 120000)


def test_coapplicant_flag(spark):
    assert one(spark, 4000, 0, 80, 360).HasCoapplicant == 0.0
    assert one(spark, 4000, 1200, 80, 360).HasCoapplicant == 1.0


def test_missing_term_uses_the_neutral_one(spark):
    assert math.isclose(one(spark, 3000, 0, 100, None).LoanAmountPerMonth, 100_000 / 360)


def test_zero_income_is_finite(spark):
    assert math.isfinite(one(spark, 0, 0, 50, 360).DebtToIncomeRatio)


def test_missing_amount(spark):
    row = one(spark, 3000, None, None, 360)
    assert row.LoanAmountPerMonth is None and row.IncomeToLoanRatio is None and row.TotalIncome == 3000
    assert one(spark, 3000, 0, None, 360, fill=100.0).IncomeToLoanRatio == 0.03


def test_batch_fill_is_the_median_of_the_frame(spark):
    df = spark.createDataFrame([(1000.0, 0.0, a, 360.0) for a in (100.0, 200.0, None)], SCHEMA)
    rows = features.add_engineered_features(df).where("LoanAmount IS NULL").collect()
    assert math.isclose(rows[0].IncomeToLoanRatio, 1000 / 150_000)


def test_text_input_is_coerced_and_missing_columns_named(spark):
    df = spark.createDataFrame([("1000", "x", "100", "360")], SCHEMA.replace("double", "string"))
    row = features.add_engineered_features(df).first()
    assert row.TotalIncome == 1000.0 and row.CoapplicantIncome is None
    with pytest.raises(features.MissingColumns, match="LoanAmount"):
        features.add_engineered_features(df.drop("LoanAmount"))


def test_batch_fill_is_refused_on_a_stream(spark, tmp_path):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path))
    with pytest.raises(ValueError, match="stream"):
        features.add_engineered_features(stream)


def test_number_reading(spark):
    texts = ["1", " 2.5 ", "1e3", "3d", "4F", "abc", "", "NaN", "inf", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(to_number(F.col("t")).alias("n")).collect()]
    assert got == [1.0, 2.5, 1000.0, None, None, None, None, None, math.inf, None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.5,), (9.0,)], "x double")
    assert [r.y for r in df.select(clip(F.col("x"), 0.0, 1.0).alias("y")).collect()] == [None, 0.0, 0.5, 1.0]
    assert df.select(percent(F.lit(0.1234)).alias("p")).first().p == "12.3%"


def test_encode_target(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("y",), ("1",)], "t string")
    assert [r.t for r in labels.encode_target(df, "t").collect()] == [1, 0, 1, 1]
    numbers = spark.createDataFrame([(1,), (0,)], "t int")
    assert [r.t for r in labels.encode_target(numbers, "t").collect()] == [1, 0]


@pytest.mark.parametrize("bad", ["MAYBE", None])
def test_unknown_labels_raise(spark, bad):
    df = spark.createDataFrame([("Y",), (bad,)], "t string")
    with pytest.raises(labels.UnknownLabels, match=str(bad)):
        labels.encode_target(df, "t")


def test_all_unknown_labels_are_kept(spark):
    df = spark.range(50).select(F.concat(F.lit("odd"), "id").alias("t"))
    with pytest.raises(labels.UnknownLabels, match="50 values") as raised:
        labels.encode_target(df, "t")
    assert raised.value.table.count() == 50


def test_decisions(spark):
    df = spark.createDataFrame([(0.5,), (0.4999999,), (0.9,)], "p double")
    out = labels.decision_columns(df, "p", 0.5, "m", "abcdefghij").collect()
    assert [r.loan_status for r in out] == ["Approved", "Rejected", "Approved"]
    assert out[1].approval_probability == 0.5 and out[0].model_version == "abcdefgh"
    assert len({r.request_id for r in out}) == 3
    assert labels.decision_columns(df, "p").first().model_version == "local"
    strict = df.select(labels.decide(F.col("p"), 0.5, inclusive=False).alias("d")).first().d
    assert strict == 0


def test_path_rewrite(spark):
    paths = ["/home/u/proj/mlartifacts/1", "mlartifacts/1", "file:///x/proj/a/proj/b", "/other/p", None]
    df = spark.createDataFrame([(p,) for p in paths], "artifact_uri string")
    once = rewrite.rewrite_paths(df, ["artifact_uri"], "proj")
    assert [r[0] for r in once.collect()] == ["mlartifacts/1", "mlartifacts/1", "a/proj/b", "/other/p", None]
    assert rewrite.changed_rows(df, ["artifact_uri"], "proj", "runs").first().asDict() == {
        "location": "runs.artifact_uri", "rows_changed": 2,
    }
    clean = spark.createDataFrame([("/a/proj/b",)], "artifact_uri string")
    again = rewrite.rewrite_paths(clean, ["artifact_uri"], "proj")
    assert rewrite.changed_rows(again, ["artifact_uri"], "proj").first().rows_changed == 0
    tables, _ = rewrite.rewrite_tables({"runs": clean}, {"runs": ["artifact_uri"]}, "proj", dry_run=True)
    assert tables["runs"].first()[0] == "/a/proj/b"
    assert clean.select(cut_at_marker(F.col("artifact_uri"), "zzz")).first()[0] == "/a/proj/b"
