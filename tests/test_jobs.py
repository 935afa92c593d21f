import pytest
from pyspark.sql import functions as F

from adjudica.jobs import main
from adjudica.plans import stages


def test_generate_and_drift(spark, tmp_path, capsys):
    raw = str(tmp_path / "raw.csv")
    assert main(["generate", "--rows", "300", "--out", raw]) == 0
    df = spark.read.option("header", True).csv(raw)
    assert df.count() == 300 and df.columns[0] == "Loan_ID"
    profile, moved = str(tmp_path / "profile"), str(tmp_path / "moved")
    table = stages.tables.read_csv(spark, raw, stages.contracts.LOAN_CONTRACT.struct_type())
    stages.store_profile(table, stages.FlowConfig(), profile)
    table.withColumns({"ApplicantIncome": F.col("ApplicantIncome") * 4}).write.parquet(moved)
    report = str(tmp_path / "report")
    assert main(["drift", "--profile", profile, "--current", raw, "--fail-on-alert"]) == 0
    assert main(["drift", "--profile", profile, "--current", moved, "--report", report]) == 0
    assert main(["drift", "--profile", profile, "--current", moved, "--fail-on-alert"]) == 1
    assert "drift alert" in capsys.readouterr().out
    assert spark.read.json(report, multiLine=True).first().drifted_features == ["ApplicantIncome"]


def test_rewrite(spark, tmp_path, capsys):
    source, out = str(tmp_path / "runs"), str(tmp_path / "out")
    spark.createDataFrame([("/a/proj/b",), ("b",)], "artifact_uri string").write.parquet(source)
    job = ["rewrite", "--table", source, "--column", "artifact_uri", "--name", "proj"]
    assert main([*job, "--dry-run"]) == 0
    assert "runs.artifact_uri: 1 paths to cut" in capsys.readouterr().out
    assert main([*job, "--out", out]) == 0
    assert [r[0] for r in spark.read.parquet(out).collect()] == ["b", "b"]
    with pytest.raises(SystemExit):
        main(job)


def test_missing_source_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        main(["drift", "--profile", str(tmp_path), "--current", str(tmp_path / "none")])
