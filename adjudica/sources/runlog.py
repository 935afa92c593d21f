"""Run log as a data source with commit and abort: ``df.write.format("runlog").mode("append").save(folder)``.

Tasks write Parquet files under names of their own; the rows of a write count from the moment its commit file is there, which one
put creates after all tasks are done. A write that fails leaves no row: its files are removed, and were never named by a commit.
So a parent run and its children, written together, are in the log together or not at all. Readers see the commits there are.

Files go through Arrow's file systems (local or mounted paths, hdfs, s3, gcs); the folder must be one that all executors reach.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

_COMMITS, _ROWS, _FAILED = "_commits", "rows", "_failed"


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)


def _remove(system: fs.FileSystem, path: str) -> None:
    with contextlib.suppress(FileNotFoundError):  # the task and the driver may both remove it
        system.delete_file(path)


def _commits(folder: str) -> list[dict]:
    """Commit records in the order of their times."""
    system, path = _system(folder)
    found = system.get_file_info(fs.FileSelector(f"{path}/{_COMMITS}", allow_not_found=True))
    out = []
    for info in found:
        if info.path.endswith(".json"):
            with system.open_input_stream(info.path) as held:
                out.append(json.loads(held.read()))
    return sorted(out, key=lambda c: (c["number"], c["id"]))


@dataclass
class _Written(WriterCommitMessage):
    file: str
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, schema: StructType):
        self.folder, self.schema, self.id = folder, schema.json(), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, path = _system(self.folder)
        system.create_dir(f"{path}/{_ROWS}", recursive=True)
        name, rows, sink = f"{self.id}-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if sink is None:
                    sink = pq.ParquetWriter(f"{path}/{_ROWS}/{name}", batch.schema, filesystem=system)
                sink.write_batch(batch)
                rows += batch.num_rows
        except BaseException:
            if sink is not None:
                sink.close()
                _remove(system, f"{path}/{_ROWS}/{name}")
            raise
        if sink is not None:
            sink.close()
            # a task that outlives its write removes its file itself
            if system.get_file_info(f"{path}/{_FAILED}/{self.id}").type != fs.FileType.NotFound:
                _remove(system, f"{path}/{_ROWS}/{name}")
        return _Written(name if rows else "", rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, path = _system(self.folder)
        system.create_dir(f"{path}/{_COMMITS}", recursive=True)
        done = [m for m in messages if m is not None and m.rows]
        number = 1 + max((c["number"] for c in _commits(self.folder)), default=0)
        record = {"id": uuid.uuid4().hex, "number": number, "schema": self.schema, "files": [m.file for m in done], "rows": [m.rows for m in done]}
        with system.open_output_stream(f"{path}/{_COMMITS}/{number:012d}-{record['id']}.json") as out:
            out.write(json.dumps(record).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Remove the files of this write; tasks that still run when another one fails have no message, and find the mark."""
        system, path = _system(self.folder)
        system.create_dir(f"{path}/{_FAILED}", recursive=True)
        with system.open_output_stream(f"{path}/{_FAILED}/{self.id}"):
            pass
        for info in system.get_file_info(fs.FileSelector(f"{path}/{_ROWS}", allow_not_found=True)):
            if info.base_name.startswith(f"{self.id}-"):
                _remove(system, info.path)


@dataclass
class _File(InputPartition):
    name: str


class _Reader(DataSourceReader):
    def __init__(self, folder: str, columns: list[str]):
        self.folder, self.columns = folder, columns

    def partitions(self) -> list[InputPartition]:
        return [_File(f) for c in _commits(self.folder) for f in c["files"]]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        system, path = _system(self.folder)
        with pq.ParquetFile(f"{path}/{_ROWS}/{partition.name}", filesystem=system) as held:
            yield from held.iter_batches(columns=self.columns)


class RunLog(DataSource):
    """Option ``path``: the log's folder. The schema is that of the first commit."""

    @classmethod
    def name(cls) -> str:
        return "runlog"

    def schema(self) -> StructType:
        commits = _commits(self.options["path"])
        if not commits:
            raise ValueError(f"{self.options['path']} holds no committed run")
        return StructType.fromJson(json.loads(commits[0]["schema"]))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema.names)

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("a run log only grows: use mode append")
        return _Writer(self.options["path"], schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RunLog)


def append_run(runs: DataFrame, folder: str) -> None:
    """Add a parent run with its children, all or none."""
    register(runs.sparkSession)
    runs.write.format("runlog").mode("append").option("path", folder).save()


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    return spark.read.format("runlog").option("path", folder).load()
