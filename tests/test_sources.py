import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adjudica.operators.contracts import LOAN_CONTRACT
from adjudica.sources import reports, synth, tables


def test_csv_gaps_types_and_dependents(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text('Dependents,LoanAmount,Gender,extra\n0,100,Male,x\n1,NA,,"a, ""b"""\n2,abc,NaN,N/A\n')
    df = tables.read_csv(spark, str(folder), LOAN_CONTRACT.struct_type())
    rows = df.collect()
    assert [r.Dependents for r in rows] == ["0", "1", "2"]
    assert [r.LoanAmount for r in rows] == [100.0, None, None]
    assert [r.Gender for r in rows] == ["Male", None, None] and rows[1].extra == 'a, "b"'
    assert "Education" not in df.columns


def test_missing_source(spark, tmp_path):
    for read in (lambda p: tables.read_csv(spark, p, StructType()), lambda p: tables.read_parquet(spark, p)):
        with pytest.raises(FileNotFoundError, match="nothing to read"):
            read(str(tmp_path / "none"))


def test_report_has_sorted_keys_and_indent(spark, tmp_path):
    df = spark.range(1).select(
        F.lit(2).alias("b"), F.struct(F.lit(1).alias("z"), F.lit(None).cast("int").alias("a")).alias("a"),
        F.current_date().alias("day"),
    )
    reports.write_report(df, str(tmp_path / "r"))
    part = next((tmp_path / "r").glob("part-*"))
    text = part.read_text()
    assert text.index('"a"') < text.index('"b"') < text.index('"day"') and "\n  " in text
    back = reports.read_report(spark, str(tmp_path / "r"), "b int, a struct<z int, a int>").first()
    assert back.b == 2 and back.a.z == 1 and back.a.a is None


def test_synthetic_table(spark):
    df = synth.generate_loan_dataset(spark, 3000, 0.04, 42)
    assert df.columns == synth.RAW_COLUMNS and df.count() == 3000
    assert df.select("Loan_ID").distinct().count() == 3000
    again = synth.generate_loan_dataset(spark, 3000, 0.04, 42).repartition(3)
    assert df.exceptAll(again).count() == 0
    assert df.exceptAll(synth.generate_loan_dataset(spark, 3000, 0.04, 43)).count() > 2900
    row = df.agg(
        F.avg((F.col("Loan_Status") == "Y").cast("int")).alias("rate"),
        F.avg((F.col("Gender") == "Male").cast("int")).alias("male"),
        F.avg(F.col("Gender").isNull().cast("int")).alias("gap"),
        F.min("LoanAmount").alias("lo"), F.max("LoanAmount").alias("hi"),
        F.count_if(F.col("Education").isNull()).alias("none"),
        F.avg(F.log("ApplicantIncome")).alias("mu"), F.stddev("ApplicantIncome").alias("sd"),
    ).first()
    assert 0.5 < row.rate < 0.8 and 0.75 < row.male < 0.81 and 0.025 < row.gap < 0.055
    assert row.lo >= 15 and row.hi <= 700 and row.none == 0 and abs(row.mu - 8.4) < 0.05
    history = df.where("Credit_History IS NOT NULL").groupBy("Credit_History").agg(
        F.avg((F.col("Loan_Status") == "Y").cast("int")).alias("r")
    )
    rates = {r.Credit_History: r.r for r in history.collect()}
    assert rates[1.0] > rates[0.0] + 0.3


@pytest.mark.parametrize("n, rate", [(0, 0.1), (-5, 0.1), (10, 0.5), (10, -0.1)])
def test_generator_arguments(spark, n, rate):
    with pytest.raises(ValueError):
        synth.generate_loan_dataset(spark, n, rate)


def test_no_gaps_when_rate_is_zero(spark):
    df = synth.generate_loan_dataset(spark, 100, 0.0)
    assert df.dropna().count() == 100
