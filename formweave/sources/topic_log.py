"""A message topic as numbered Parquet files in a shared folder, as a Python data source: ``format("topic_log")``.

For clusters without the jar of a broker. A topic has a fixed number of partitions; a file in ``partition=p`` is named
by the offset of its first message, and a message is known by its partition and offset. A stream's progress is one
offset per partition, kept in its checkpoint, so a restart reads exactly the files, and parts of files, it had planned.

Each task of a writer stages one file. A commit first fixes the list of its files under the key of the write, then
links each file to the end of its partition; linking is atomic and fails where another writer was first, who is then
followed. A commit that is repeated under its key, whole or in part, keeps to the first list and links what is not yet
linked, so a batch that a restart writes again is there once. Python on all executors must reach the folder by the same
path, and its file system must have hard links.

Options: ``path``; ``partitions`` of a new topic (8); ``writeId``, the key of a write, by default a new one. A stream's
batch numbers are added to its key, so two streams into one topic need keys of their own.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import parquet
from pyspark import TaskContext, cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

FORMAT = "topic_log"
PARTITIONS = 8
PLACED = "message_id string, publish_time timestamp, attributes map<string,string>, payload binary, partition int, offset bigint"
BATCH_ROWS = 4096


def local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def files_of(path: str, partition: int) -> list[tuple[int, str]]:
    """First offset and name of each file of a partition, in order."""
    names = glob.glob(f"{glob.escape(path)}/partition={partition}/*.parquet")
    return sorted((int(os.path.basename(n)[:-len(".parquet")]), n) for n in names)


def end_of(path: str, partition: int) -> int:
    """The offset after the last message of a partition."""
    files = files_of(path, partition)
    return files[-1][0] + parquet.read_metadata(files[-1][1]).num_rows if files else 0


def ends(path: str) -> dict[str, int]:
    return {str(p): end_of(path, p) for p in range(partitions_of(path))}


def partitions_of(path: str) -> int:
    try:
        with open(f"{path}/topic.json", encoding="utf-8") as told:
            return json.load(told)["partitions"]
    except FileNotFoundError:
        return 0


def put_once(path: str, content: dict) -> dict:
    """Write a small file as a whole unless it is there; what it then holds."""
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "w", encoding="utf-8") as out:
        json.dump(content, out)
    try:
        os.link(own, path)
    except FileExistsError:
        pass
    os.remove(own)
    with open(path, encoding="utf-8") as told:
        return json.load(told)


def slices(path: str, start: dict, end: dict) -> list[InputPartition]:
    """One input partition (file, rows to skip, rows to read, partition, offset) per file between two places."""
    out = []
    for partition, until in end.items():
        since = start.get(partition, 0)
        files = files_of(path, int(partition))
        for (first, name), (after, _) in zip(files, [*files[1:], (max(until, since), "")]):
            low, high = max(first, since), min(after, until)
            if low < high:
                out.append(InputPartition((name, low - first, high - low, int(partition), low)))
    return out


def read_slice(name: str, skip: int, rows: int, partition: int, offset: int) -> Iterator[pa.RecordBatch]:
    for batch in parquet.ParquetFile(name).iter_batches(BATCH_ROWS):
        here = batch.slice(min(skip, batch.num_rows), rows)
        skip = max(0, skip - batch.num_rows)
        if not here.num_rows:
            continue
        places = pa.array(range(offset, offset + here.num_rows), pa.int64())
        yield pa.RecordBatch.from_arrays([*here.columns, pa.array([partition] * here.num_rows, pa.int32()), places],
                                         names=[*here.schema.names, "partition", "offset"])
        rows -= here.num_rows
        offset += here.num_rows
        if not rows:
            return


def link_at_end(staged: str, path: str, partition: int) -> None:
    """Link a staged file to the end of its partition, unless it is linked already."""
    os.makedirs(f"{path}/partition={partition}", exist_ok=True)
    while os.stat(staged).st_nlink == 1:
        try:
            os.link(staged, f"{path}/partition={partition}/{end_of(path, partition):020d}.parquet")
        except FileExistsError:
            continue


class TopicWriter:
    def __init__(self, options: dict[str, str]):
        self.path, self.key = local(options["path"]), options.get("writeId") or uuid.uuid4().hex
        for folder in ("staged", "commits"):
            os.makedirs(f"{self.path}/{folder}", exist_ok=True)
        self.partitions = put_once(f"{self.path}/topic.json", {"partitions": int(options.get("partitions", PARTITIONS))})["partitions"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        told = WriterCommitMessage()
        told.name, told.task, writer = f"{uuid.uuid4().hex}.parquet", TaskContext.get().partitionId(), None
        for batch in iterator:
            if batch.num_rows:
                if writer is None:
                    writer = parquet.ParquetWriter(f"{self.path}/staged/{told.name}", batch.schema)
                writer.write_batch(batch)
        if writer is None:
            told.name = None
        else:
            writer.close()
        return told

    def complete(self, messages: Sequence[WriterCommitMessage | None], key: str) -> None:
        files = sorted((m.task, m.name) for m in messages if m is not None and m.name)
        # Writes begin at different partitions, so that many small ones fill all.
        first = sum(key.encode())
        mine = {"files": [[name, (task + first) % self.partitions] for task, name in files]}
        kept = put_once(f"{self.path}/commits/{quote(key, safe='')}.json", mine)
        for name, partition in kept["files"]:
            link_at_end(f"{self.path}/staged/{name}", self.path, partition)
        self.drop(messages, {name for name, _ in kept["files"]})

    def drop(self, messages: Sequence[WriterCommitMessage | None], keep: set[str] = frozenset()) -> None:
        for message in messages:
            if message is not None and message.name and message.name not in keep:
                os.remove(f"{self.path}/staged/{message.name}")


class BatchWriter(TopicWriter, DataSourceArrowWriter):
    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self.complete(messages, self.key)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.drop(messages)


class StreamWriter(TopicWriter, DataSourceStreamArrowWriter):
    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.complete(messages, f"{self.key}-{batchId}")

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.drop(messages)


class BatchReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return slices(self.path, {}, ends(self.path)) or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return read_slice(*partition.value) if partition.value else iter(())


class StreamReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return ends(self.path)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return slices(self.path, start, end)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return read_slice(*partition.value)


class TopicLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return PLACED

    def reader(self, schema) -> BatchReader:
        return BatchReader(local(self.options["path"]))

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(local(self.options["path"]))

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("a topic is only appended to")
        return BatchWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
        if not self.options.get("writeId"):
            raise ValueError("missing required option: writeId")
        return StreamWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session. The classes travel by value: executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TopicLog)
