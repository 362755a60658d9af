"""A stored table as a stream of a bounded rate, and a sink that publishes a micro-batch in one step.

Both are Python data sources. Rows of the table come about at so many a second from a given start on, as if a
sender paced them; what is due after a pause comes at once, and the offset is a row number, so a restarted
stream goes on where its checkpoint says. The sink's tasks write files that nobody reads yet; the commit of a micro-batch
names them in one manifest, which is put in place by a rename. A batch that is repeated after a failed commit writes
new files and its manifest takes the place of any earlier one, so no row is published twice or lost.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from riskloom.session import ship_package

#: Rows that one task reads at most, and rows that it holds at a time.
TASK_ROWS = 100_000
HELD_ROWS = 4_096
#: Bytes of a column that are read at a time.
BUFFER_BYTES = 1 << 20


def _filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path and the path in it; a path without a scheme is a shared local one."""
    if "://" not in path:
        path = f"file://{path.removeprefix('file:')}"
    return pyarrow.fs.FileSystem.from_uri(path)


@dataclass
class Rows(InputPartition):
    """Rows ``first`` to ``last`` (exclusive) of one file."""

    file: str
    first: int
    last: int


class ReplayReader(DataSourceStreamReader):
    def __init__(self, folder: str, rate: float, started: float, columns: Sequence[str]):
        self.folder, self.rate, self.started, self.columns = folder, rate, started, list(columns)
        system, path = _filesystem(folder)
        found = system.get_file_info(pyarrow.fs.FileSelector(path, recursive=True))
        files = sorted(f.path for f in found if f.is_file and f.base_name.endswith(".parquet"))
        # From the files' footers; the rows themselves are read by tasks.
        self.files = [(f, pq.ParquetFile(f, filesystem=system).metadata.num_rows) for f in files]
        self.total = sum(n for _, n in self.files)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"row": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"row": min(self.total, int(max(0.0, time.time() - self.started) * self.rate))}

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        out, at = [], 0
        for file, n in self.files:
            low, high = max(start["row"] - at, 0), min(end["row"] - at, n)
            out += [Rows(file, a, min(a + TASK_ROWS, high)) for a in range(low, high, TASK_ROWS)]
            at += n
        return out

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        system, _ = _filesystem(self.folder)
        file, at = pq.ParquetFile(partition.file, filesystem=system, buffer_size=BUFFER_BYTES, pre_buffer=False), 0
        for group in range(file.metadata.num_row_groups):
            n = file.metadata.row_group(group).num_rows
            if at < partition.last and at + n > partition.first:
                begin = at
                for batch in file.iter_batches(HELD_ROWS, row_groups=[group], columns=self.columns, use_threads=False):
                    if begin >= partition.last:
                        break
                    low, high = max(partition.first - begin, 0), min(partition.last - begin, batch.num_rows)
                    if high > low:
                        yield batch.slice(low, high - low)
                    begin += batch.num_rows
            at += n

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    file: str | None


class PublishingWriter(DataSourceStreamWriter):
    def __init__(self, folder: str, columns: Sequence[str]):
        self.folder, self.columns = folder.rstrip("/"), list(columns)

    def write(self, iterator: Iterator) -> Written:
        """Rows of one task as JSON lines in a file of their own; none for no rows."""
        system, path = _filesystem(self.folder)
        system.create_dir(f"{path}/data")
        name, out = f"{uuid.uuid4().hex}.json", None
        for row in iterator:
            if out is None:
                out = system.open_output_stream(f"{path}/data/{name}")
            out.write(json.dumps(row.asDict(recursive=True), default=str).encode() + b"\n")
        if out is not None:
            out.close()
        return Written(name if out is not None else None)

    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        system, path = _filesystem(self.folder)
        system.create_dir(f"{path}/batches")
        files = [m.file for m in messages if m is not None and m.file]
        temporary = f"{path}/batches/_{uuid.uuid4().hex}"
        with system.open_output_stream(temporary) as out:
            out.write("".join(json.dumps({"batch": batchId, "file": f}) + "\n" for f in files).encode())
        system.move(temporary, f"{path}/batches/batch-{batchId}.json")

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        system, path = _filesystem(self.folder)
        for message in messages:
            if message is not None and message.file:
                system.delete_file(f"{path}/data/{message.file}")


class ReplaySource(DataSource):
    """``format("riskloom_replay")`` reads with options path, rows_per_second and started (in seconds); it writes to path."""

    @classmethod
    def name(cls) -> str:
        return "riskloom_replay"

    def streamReader(self, schema: StructType) -> ReplayReader:  # noqa: N802
        return ReplayReader(self.options["path"], float(self.options["rows_per_second"]), float(self.options["started"]), schema.names)

    def streamWriter(self, schema: StructType, overwrite: bool) -> PublishingWriter:  # noqa: N802
        return PublishingWriter(self.options["path"], schema.names)


def replayed(spark: SparkSession, folder: str, rows_per_second: float, started: float | None = None) -> DataFrame:
    """The Parquet files below ``folder``, in order of their names, as a stream that begins at ``started``.

    A restart passes the same ``started``. The folder must be readable under the same name from the driver and the tasks.
    """
    ship_package(spark)
    spark.dataSource.register(ReplaySource)
    schema = spark.read.parquet(folder).schema
    begin = time.time() if started is None else started
    reader = spark.readStream.format("riskloom_replay").schema(schema)
    return reader.options(path=folder, rows_per_second=rows_per_second, started=begin).load()


def publishing(rows: DataFrame, folder: str):
    """A stream writer whose micro-batches appear in ``folder`` whole or not at all."""
    ship_package(rows.sparkSession)
    rows.sparkSession.dataSource.register(ReplaySource)
    return rows.writeStream.format("riskloom_replay").option("path", folder).outputMode("append")


def published(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """The rows of all published micro-batches."""
    named = spark.read.schema("batch long, file string").json(f"{folder}/batches").select("file")
    rows = spark.read.schema(schema).json(f"{folder}/data").withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return rows.join(named.withColumnRenamed("file", "_file"), "_file", "left_semi").drop("_file")
