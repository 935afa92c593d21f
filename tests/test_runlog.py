"""The run log keeps whole writes only; the package reaches workers that start elsewhere."""

import os
import subprocess
import sys

import pyarrow as pa
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adjudica.sources import runlog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_failed_write_leaves_no_row_and_no_file(spark, tmp_path):
    folder = str(tmp_path / "log")
    runs = spark.range(20).select(F.concat(F.lit("run-"), "id").alias("run_id"), F.col("id").alias("ordinal")).repartition(4)
    runlog.append_run(runs, folder)
    broken = runs.withColumn("ordinal", F.when(F.col("ordinal") == 13, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("ordinal")))
    with pytest.raises((PySparkException, Py4JJavaError)):
        runlog.append_run(broken, folder)
    assert runlog.read_runs(spark, folder).count() == 20
    named = {f for c in runlog._commits(folder) for f in c["files"]}
    assert {f for f in os.listdir(f"{folder}/rows") if f.endswith(".parquet")} == named
    runlog.append_run(runs.where("ordinal < 5"), folder)
    found = runlog.read_runs(spark, folder)
    assert found.count() == 25 and found.columns == ["run_id", "ordinal"]
    assert [c["number"] for c in runlog._commits(folder)] == [1, 2]


def test_overwriting_and_empty_logs_are_refused(spark, tmp_path):
    runlog.register(spark)
    with pytest.raises((PySparkException, Py4JJavaError, ValueError)):
        spark.range(3).write.format("runlog").mode("overwrite").option("path", str(tmp_path / "x")).save()
    with pytest.raises((PySparkException, Py4JJavaError, ValueError)):
        runlog.read_runs(spark, str(tmp_path / "none")).count()


def test_workers_find_the_package_from_another_folder(tmp_path):
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r}); from adjudica.session import local_session; from adjudica.operators import newton; "
        "s = local_session(2); d = s.createDataFrame([(float(i), i % 2) for i in range(20)], 'a double, y int'); "
        "print('weights', len(newton.fit_newton(d, 'y', ['a']).weights))"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "weights 2" in out.stdout, out.stderr[-2000:]


def test_a_task_that_outlives_a_failed_write_removes_its_file(tmp_path):
    """Its file stayed: the driver had removed what it knew of before the task ended."""
    folder = str(tmp_path / "log")
    batch = pa.record_batch([pa.array(["run-1"])], names=["run_id"])
    writer = runlog._Writer(folder, StructType([StructField("run_id", StringType())]))

    def batches():
        yield batch
        writer.abort([None])
        yield batch

    early = writer.write(iter([batch]))
    writer.write(batches())
    assert early.rows == 1 and os.listdir(f"{folder}/rows") == [] and runlog._commits(folder) == []
    kept = runlog._Writer(folder, StructType([StructField("run_id", StringType())]))
    kept.commit([kept.write(iter([batch]))])
    assert os.listdir(f"{folder}/rows") == runlog._commits(folder)[0]["files"]
