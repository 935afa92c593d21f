"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ARROW = {
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "array<double>": pa.list_(pa.float64()),
}


_OWN: list[tempfile.TemporaryDirectory] = []
_MADE: list[str] = []
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(cores: int | str = 8, name: str = "adjudica", **conf: str) -> SparkSession:
    """Session for tests and the local benchmark. A cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    return session


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, wherever they start; once for each Spark context."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    held = tempfile.TemporaryDirectory(prefix="adjudica-ship-")
    archive = os.path.join(held.name, f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)  # Spark takes the file to its workers
    _SHIPPED[context.applicationId] = held


def work_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a temporary folder;
    on a cluster a missing setting is an error, because a machine-local folder
    would not survive the loss of that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.TemporaryDirectory(prefix="adjudica-")
    _OWN.append(own)  # removed when this process ends
    spark.conf.set("spark.checkpoint.dir", own.name)
    return own.name


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared root, which ``drop_work`` removes."""
    path = os.path.join(work_root(spark), f"{purpose}-{uuid.uuid4().hex}")
    _MADE.append(path)
    return path


def drop_work(spark: SparkSession) -> None:
    """Remove the intermediate folders of this process; what lazily reads them ends with them."""
    while _MADE:
        drop_folder(spark, _MADE[-1])


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove one of the folders that ``work_dir`` named."""
    _MADE.remove(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table below the shared root and read it again: its lineage is
    cut there, and its size is known to the planner."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of fitted values. Arrow input becomes a local relation: no job runs to
    read it, and the planner knows how small it is."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(list(values), _ARROW[kind]) for values, (_, kind) in zip(columns, fields)]
    return spark.createDataFrame(pa.table(arrays, names=[name for name, _ in fields]))
