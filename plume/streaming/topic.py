"""A message topic as a partitioned, append-only log in a shared folder, read and written through Spark's data source API.

A message goes to one of the topic's partitions by the hash of its key, and gets the next offset there.  A write puts
its messages into files of one partition each and then adds one entry to ``log/``, which gives every file its first
offset; messages without an entry do not exist.  One writer commits at a time.

The streaming reader starts from the earliest offset (or the latest), takes at most ``maxMessages`` of each partition
into a batch, and cuts large ranges into tasks.  Its offsets are one number per partition, so Spark's checkpoint says
exactly which messages a batch had: a restart goes on behind them, and a batch that was cut off is read again as it
was.  ``progress`` names a folder where the end of the last planned batch is noted, which a restarted reader needs to
bound its next batch.  The folders must be on a file system that Arrow opens (local or shared paths, HDFS, S3).
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage,
)

FORMAT = "message_log"
SCHEMA = "key string, value string, partition int, offset long"
STORED = pa.schema([("key", pa.string()), ("value", pa.string())])
TASK_MESSAGES = 1_000_000
LEVEL = 9  # texts take a third less than with the default codec, in little more time


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _names(files: fs.FileSystem, folder: str, end: str) -> list[str]:
    found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name.endswith(end))


def _put(files: fs.FileSystem, folder: str, name: str, value) -> None:
    """A whole JSON file or none: written under another name, then moved."""
    files.create_dir(folder, recursive=True)
    draft = f"{folder}/{uuid.uuid4().hex}.draft"
    with files.open_output_stream(draft) as out:
        out.write(json.dumps(value).encode())
    files.move(draft, f"{folder}/{name}")


def _get(files: fs.FileSystem, path: str):
    with files.open_input_stream(path) as f:
        return json.loads(f.read().decode())


class _Log:
    """The committed files of every partition, in order of their offsets; entries are read once."""

    def __init__(self, path: str):
        self.files, self.root = _open(path.rstrip("/"))
        self.seen = 0
        self.parts: dict[int, list[tuple[int, int, str]]] = {}  # partition: (first offset, messages, file)

    def refresh(self) -> _Log:
        for name in _names(self.files, f"{self.root}/log", ".json")[self.seen:]:
            for p, first, n, file in _get(self.files, f"{self.root}/log/{name}")["files"]:
                self.parts.setdefault(p, []).append((first, n, file))
            self.seen += 1
        return self

    def ends(self) -> dict[int, int]:
        return {p: files[-1][0] + files[-1][1] for p, files in self.parts.items()}

    def between(self, p: int, start: int, end: int) -> list[tuple[str, int, int, int]]:
        """(file, first row, rows, offset) of the messages from ``start`` to ``end``."""
        out = []
        for first, n, file in self.parts.get(p, []):
            a, b = max(first, start), min(first + n, end)
            if a < b:
                out.append((file, a - first, b - a, a))
        return out


class _Range(InputPartition):
    def __init__(self, partition: int, file: str, row: int, rows: int, offset: int):
        self.partition, self.file, self.row, self.rows, self.offset = partition, file, row, rows, offset


class TopicReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.log = _Log(self.path)
        self.most = int(options["maxMessages"]) if "maxMessages" in options else None
        self.latest = options.get("startingOffsets", "earliest") == "latest"
        self.progress = options.get("progress")
        if self.most and not self.progress:
            raise ValueError("maxMessages needs progress, a folder of this query's own")
        self.at: dict[int, int] | None = None

    def initialOffset(self) -> dict:
        self.at = dict(self.log.refresh().ends()) if self.latest else {}
        return {str(p): n for p, n in self.at.items()}

    def latestOffset(self) -> dict:
        ends = self.log.refresh().ends()
        if self.most:
            if self.at is None:  # a restart: behind the batch that was planned last
                files, root = _open(self.progress)
                noted = _names(files, root, ".json")
                self.at = {int(p): n for p, n in (_get(files, f"{root}/{noted[-1]}") if noted else {}).items()}
            ends = {p: min(n, self.at.get(p, 0) + self.most) for p, n in ends.items()}
        return {str(p): n for p, n in ends.items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.log.refresh()
        self.at = {int(p): n for p, n in end.items()}
        if self.most:
            files, root = _open(self.progress)
            _put(files, root, "planned.json", end)
        out: list[InputPartition] = []
        for p, n in end.items():
            for file, row, rows, offset in self.log.between(int(p), start.get(p, 0), n):
                for k in range(0, rows, TASK_MESSAGES):
                    out.append(_Range(int(p), f"{self.path.rstrip('/')}/{file}", row + k, min(TASK_MESSAGES, rows - k), offset + k))
        return out

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        files, path = _open(partition.file)
        skip, left, offset = partition.row, partition.rows, partition.offset
        with pq.ParquetFile(files.open_input_file(path)) as f:
            for b in f.iter_batches(10_000):
                if skip >= len(b):
                    skip -= len(b)
                    continue
                b = b.slice(skip, left)
                skip, m = 0, len(b)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array([partition.partition] * m, pa.int32()),
                     pa.array(range(offset, offset + m), pa.int64())], ["key", "value", "partition", "offset"])
                left, offset = left - m, offset + m
                if not left:
                    return


class _Written(WriterCommitMessage):
    def __init__(self, task: int, files: list[tuple[int, int, str]]):
        self.task, self.files = task, files


class TopicWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext
        files, root = _open(self.path.rstrip("/"))
        files.create_dir(f"{root}/data", recursive=True)
        open_: dict[int, list] = {}  # partition: writer, messages, file; a task has few partitions
        for b in iterator:
            for p in pc.unique(b.column("partition")).to_pylist():
                mine = b.filter(pc.equal(b.column("partition"), p)).select(["key", "value"]).cast(STORED)
                if p not in open_:
                    name = f"data/{uuid.uuid4().hex}.parquet"
                    writer = pq.ParquetWriter(f"{root}/{name}", STORED, filesystem=files, compression="zstd",
                                              compression_level=LEVEL)
                    open_[p] = [writer, 0, name]
                open_[p][0].write_batch(mine)
                open_[p][1] += len(mine)
        for w, _, _ in open_.values():
            w.close()
        return _Written(TaskContext.get().partitionId(), [(p, n, name) for p, (_, n, name) in open_.items()])

    def commit(self, messages) -> None:
        log = _Log(self.path).refresh()
        ends, out = log.ends(), []
        for m in sorted((m for m in messages if m), key=lambda m: m.task):
            for p, n, name in m.files:
                out.append([p, ends.get(p, 0), n, name])
                ends[p] = ends.get(p, 0) + n
        if out:
            _put(log.files, f"{log.root}/log", f"{log.seen:020d}.json", {"files": out})


class MessageLog(DataSource):
    """Options: path; to read startingOffsets (earliest, latest), maxMessages (of a partition in a batch), progress."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TopicReader:
        return TopicReader(self.options)

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        if overwrite:
            raise ValueError("a topic is append-only")
        return TopicWriter(self.options)


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module


def publish(messages: DataFrame, path: str, partitions: int = 8) -> None:
    """Append ``(key, value)`` messages; those of one key keep to one partition.  A null key counts as empty.

    Every task writes its own messages, a file for each of the topic's partitions: none is moved for it, so a task's
    share does not grow with the topic, which has few partitions."""
    spark = messages.sparkSession
    spark.dataSource.register(MessageLog)
    at = F.pmod(F.xxhash64(F.coalesce(F.col("key"), F.lit(""))), F.lit(partitions)).cast("int")
    messages.select("key", "value", at.alias("partition")).write.format(FORMAT).mode("append").save(path)


def read_topic(spark: SparkSession, path: str, starting_offsets: str = "earliest", max_messages: int | None = None,
               progress: str | None = None) -> DataFrame:
    """Streaming ``(key, value, partition, offset)`` of a topic."""
    spark.dataSource.register(MessageLog)
    r = spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting_offsets)
    if max_messages:
        r = r.option("maxMessages", str(max_messages)).option("progress", progress)
    return r.load()
