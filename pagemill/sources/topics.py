"""Message topics as a Spark data source: a log of segments with offsets, consumer groups that remember theirs, and writers that commit.

A topic is a folder. Tasks write segments, Parquet files of one partition each, under names of their own; nothing reads them until the writer's
commit lists them in the next file of the topic's log, with the offset of their first message. So a failed task or job leaves files behind but no
messages. A reader's offsets are the next message of each partition; a streaming query keeps them in its checkpoint, and a group's file has what it
committed last, from where a new query of that group starts. One writer commits to a topic at a time, any number of groups read it.

Batch: ``spark.read.format("topic")``, ``df.write.format("topic").mode("append")``; streams likewise. Options: ``path`` of all topics, ``topic``, ``group``
for readers, ``partitions`` where a topic is new, ``writer`` to name a stream's writer.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

SCHEMA = "partition int, offset long, key string, value binary, time timestamp"
#: Partitions of a topic that doesn't say; messages of a segment.
PARTITIONS, SEGMENT_ROWS = 4, 100_000


class Topic:
    """The files of one topic."""

    def __init__(self, options: dict[str, str]):
        self.root = f"{options['path'].rstrip('/')}/{options['topic']}"
        self.partitions = int(options.get("partitions", PARTITIONS))

    def store(self) -> tuple[pa.fs.FileSystem, str]:
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.root)

    def names(self, folder: str) -> list[str]:
        from pyarrow import fs

        store, root = self.store()
        return sorted(f.path for f in store.get_file_info(fs.FileSelector(f"{root}/{folder}", allow_not_found=True)) if f.path.endswith(".json"))

    def load(self, path: str) -> dict:
        with self.store()[0].open_input_stream(path) as f:
            return json.loads(f.read())

    def save(self, name: str, content: dict) -> None:
        """A file appears whole or not at all."""
        store, root = self.store()
        store.create_dir(f"{root}/{name}".rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(part := f"{root}/{name}.{uuid.uuid4().hex}") as f:
            f.write(json.dumps(content).encode())
        store.move(part, f"{root}/{name}")

    def last(self) -> dict:
        """The newest entry of the log; ``next`` holds the offset after the last message of each partition."""
        names = self.names("log")
        return self.load(names[-1]) if names else {"next": {str(p): 0 for p in range(self.partitions)}, "segments": [], "writers": {}}

    def commit(self, segments: list[list], writer: str | None = None, batch: int = 0) -> None:
        """Adds segments (file, partition, rows) to the log. A stream's batch that was committed before isn't added again."""
        before = self.last()
        if writer and before["writers"].get(writer, -1) >= batch:
            return self.remove(segments)
        ends, placed = dict(before["next"]), []
        for file, partition, rows in sorted(segments, key=lambda s: s[1]):
            placed.append([file, partition, ends[str(partition)], rows])
            ends[str(partition)] += rows
        writers = before["writers"] | ({writer: batch} if writer else {})
        return self.save(f"log/{len(self.names('log')):020d}.json", {"next": ends, "segments": placed, "writers": writers})

    def remove(self, segments: list[list]) -> None:
        store, root = self.store()
        for file, *_ in segments:
            store.delete_file(f"{root}/data/{file}")

    def between(self, start: dict, end: dict) -> list[Stretch]:
        """The messages from ``start`` until before ``end``, newest entries of the log first."""
        out = []
        for name in reversed(self.names("log")):
            entry = self.load(name)
            for file, partition, first, rows in entry["segments"]:
                a, b = max(first, start[str(partition)]), min(first + rows, end[str(partition)])
                if a < b:
                    out.append(Stretch(file, partition, first, a, b))
            if all(entry["next"][p] <= start[p] for p in start):
                break
        return sorted(out, key=lambda s: (s.partition, s.first))

    def write(self, batches: Iterator[pa.RecordBatch]) -> list[list]:
        """Segments of a task's rows (key, value, time), dealt by key; rows without a key go to the first partition."""
        import pyarrow.parquet as pq

        store, root = self.store()
        store.create_dir(f"{root}/data", recursive=True)
        partitions = len(self.last()["next"])
        held: dict[int, list[pa.RecordBatch]] = {}
        out = []

        def flush(p: int) -> None:
            table = pa.Table.from_batches(held.pop(p))
            name = f"{uuid.uuid4().hex}.parquet"
            with store.open_output_stream(f"{root}/data/{name}") as f:
                pq.write_table(table, f, compression="zstd")
            out.append([name, p, table.num_rows])

        for batch in batches:
            batch = batch.select(["key", "value", "time"])
            to = pa.array([0 if k is None else zlib.crc32(k.encode()) % partitions for k in batch.column(0).to_pylist()], pa.int32())
            for p in to.unique().to_pylist():
                held.setdefault(p, []).append(batch.filter(pa.compute.equal(to, p)))
                if sum(b.num_rows for b in held[p]) >= SEGMENT_ROWS:
                    flush(p)
        for p in list(held):
            flush(p)
        return out

    def read(self, s: Stretch) -> Iterator[pa.RecordBatch]:
        """The messages of a stretch with their places, in order."""
        import pyarrow.parquet as pq

        store, root = self.store()
        with store.open_input_file(f"{root}/data/{s.file}") as f:
            at = s.first
            for batch in pq.ParquetFile(f).iter_batches():
                a, b = max(s.start, at) - at, min(s.end, at + batch.num_rows) - at
                if a < b:
                    own = batch.slice(a, b - a)
                    yield pa.RecordBatch.from_arrays([pa.array([s.partition] * (b - a), pa.int32()), pa.array(range(at + a, at + b), pa.int64()), *own.columns], ["partition", "offset", *own.schema.names])
                at += batch.num_rows


@dataclass
class Stretch(InputPartition):
    """Messages ``start`` until before ``end`` of a segment whose first one is ``first``."""

    file: str
    partition: int
    first: int
    start: int
    end: int


@dataclass
class Segments(WriterCommitMessage):
    written: list[list]


class BatchReader(DataSourceReader):
    """All messages there are."""

    def __init__(self, topic: Topic):
        self.topic = topic

    def partitions(self) -> Sequence[Stretch]:
        end = self.topic.last()["next"]
        return self.topic.between({p: 0 for p in end}, end)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        yield from self.topic.read(partition)


class StreamReader(DataSourceStreamReader):
    """A group's messages: from what it committed last, at first from the earliest."""

    def __init__(self, topic: Topic, group: str | None):
        self.topic, self.group = topic, group

    def initialOffset(self) -> dict:
        begun = {p: 0 for p in self.topic.last()["next"]}
        return begun | (committed(self.topic, self.group) if self.group else {})

    def latestOffset(self) -> dict:
        return self.topic.last()["next"]

    def partitions(self, start: dict, end: dict) -> Sequence[Stretch]:
        return self.topic.between(start, end)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        yield from self.topic.read(partition)

    def commit(self, end: dict) -> None:
        if self.group:
            self.topic.save(f"groups/{self.group}.json", end)


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, topic: Topic):
        self.topic = topic

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Segments:
        return Segments(self.topic.write(iterator))

    def commit(self, messages: list[Segments | None]) -> None:
        self.topic.commit([s for m in messages if m for s in m.written])

    def abort(self, messages: list[Segments | None]) -> None:
        self.topic.remove([s for m in messages if m for s in m.written])


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, topic: Topic, writer: str):
        self.topic, self.writer = topic, writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Segments:
        return Segments(self.topic.write(iterator))

    def commit(self, messages: list[Segments | None], batchId: int) -> None:
        self.topic.commit([s for m in messages if m for s in m.written], self.writer, batchId)

    def abort(self, messages: list[Segments | None], batchId: int) -> None:
        self.topic.remove([s for m in messages if m for s in m.written])


class TopicSource(DataSource):
    """``topic``; see the module."""

    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BatchReader:
        return BatchReader(Topic(self.options))

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(Topic(self.options), self.options.get("group"))

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        if overwrite:
            raise ValueError("a topic is only appended to")
        return BatchWriter(Topic(self.options))

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
        return StreamWriter(Topic(self.options), self.options.get("writer", "stream"))


def committed(topic: Topic, group: str) -> dict[str, int]:
    """The offsets that a group committed; none for a new one."""
    paths = [p for p in topic.names("groups") if p.endswith(f"/{group}.json")]
    return topic.load(paths[0]) if paths else {}


def lag(path: str, topic: str, group: str) -> dict[str, int]:
    """Messages of each partition that a group has not committed yet."""
    t = Topic({"path": path, "topic": topic})
    done = committed(t, group)
    return {p: end - done.get(p, 0) for p, end in t.last()["next"].items()}


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TopicSource)


def consume(spark: SparkSession, path: str, topic: str, group: str):
    """A stream of a topic's messages for a group."""
    register(spark)
    return spark.readStream.format("topic").option("path", path).option("topic", topic).option("group", group).load()


def produce(rows, path: str, topic: str, partitions: int = PARTITIONS) -> None:
    """Appends rows (key, value, time) to a topic, in one commit."""
    register(rows.sparkSession)
    rows.select("key", "value", "time").write.format("topic").option("path", path).option("topic", topic).option("partitions", partitions).mode("append").save()
