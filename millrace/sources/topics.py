"""Stored topics as a Spark data source: records by topic, partition and offset, read and written in batches and streams.

A topic folder holds data files and a log. A data file has consecutive records of one partition of one topic; an
entry of the log names the files of one committed write, the first offset of each, and where every partition then ends.
A write puts its files down first and adds its entry last, so readers see all of a write or nothing, and files
of a failed task are never named. One writer at a time adds to a folder.

    topics.register(spark)
    records.write.format("topic").option("topic", "events").mode("append").save(path)
    spark.readStream.format("topic").option("subscribe", "events").load(path)

Options to read: ``subscribe`` (a list with commas), ``subscribePattern`` or ``assign`` (JSON of topic to partitions);
``startingOffsets`` and, in a batch, ``endingOffsets``: earliest, latest, or JSON of topic to partition to offset, where -2 is the
earliest and -1 the latest; ``maxOffsetsPerTrigger`` and ``group``, under which a stream's position is kept for that limit.
To write: ``topic``, ``partitions`` (8), ``writer``, a name under which a repeated batch of a stream is known. A record's partition
is in the column ``partition`` if there is one, else the crc32 of its key.
"""

from __future__ import annotations

import datetime
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

# Fixed value: the connector's row layout.
SCHEMA = ("key binary, value binary, topic string, partition int, offset bigint, "
          "timestamp timestamp, timestampType int")
EARLIEST, LATEST = -2, -1
# Records of a data file and of a reading task.
FILE_RECORDS = 1_000_000


def register(spark: SparkSession) -> None:
    """Make the format ``topic`` known to the session."""
    spark.dataSource.register(TopicSource)


# --- the folder -----------------------------------------------------------

class Folder:
    """The files and the log of a topic folder, on any file system Arrow can open."""

    def __init__(self, path: str):
        if re.match(r"^[a-z0-9]+:/(?!/)", path):
            path = path.replace(":/", ":///", 1)
        self.fs, self.root = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
        self.root = self.root.rstrip("/")

    def entries(self, first: int = 0) -> list[tuple[int, str]]:
        """(number, path) of the log's entries from ``first`` on, in order."""
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/log", allow_not_found=True))
        names = sorted((int(f.base_name[:-5]), f.path) for f in found if re.fullmatch(r"\d+\.json", f.base_name))
        return [n for n in names if n[0] >= first]

    def read(self, path: str) -> dict:
        with self.fs.open_input_stream(path) as file:
            return json.loads(file.read())

    def put(self, path: str, value: dict) -> None:
        """Write a small file whole: under another name first."""
        self.fs.create_dir(os.path.dirname(path), recursive=True)
        draft = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as file:
            file.write(json.dumps(value).encode())
        self.fs.move(draft, path)

    def last(self) -> tuple[int, dict]:
        """Number and content of the newest entry; -1 and an empty one in a new folder."""
        names = self.entries()
        return (names[-1][0], self.read(names[-1][1])) if names else (-1, {"ends": {}, "writers": {}, "files": []})

    def commit(self, parts: list[Part], writer: str, batch: int | None) -> None:
        """Name the files of a write in the log, in the order of ``parts``; a batch that is there already is passed over."""
        number, before = self.last()
        if batch is not None and batch <= before["writers"].get(writer, -1):
            self.remove(parts)
            return
        ends, files = before["ends"], []
        for p in parts:
            end = ends.setdefault(p.topic, {}).setdefault(str(p.partition), 0)
            files.append([p.topic, p.partition, end, p.records, p.file])
            ends[p.topic][str(p.partition)] = end + p.records
        writers = before["writers"] | ({writer: batch} if batch is not None else {})
        self.put(f"{self.root}/log/{number + 1:020d}.json", {"files": files, "ends": ends, "writers": writers})

    def remove(self, parts: list[Part]) -> None:
        for p in parts:
            self.fs.delete_file(f"{self.root}/data/{p.file}")


@dataclass
class Part:
    """A data file of a task."""

    topic: str
    partition: int
    records: int
    file: str


# --- writing --------------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    task: int
    parts: list = field(default_factory=list)


class Writer(DataSourceArrowWriter, DataSourceStreamArrowWriter):
    """Tasks write data files; the driver names them in the log, in the order of the tasks."""

    def __init__(self, options: dict):
        self.path, self.topic = options["path"], options.get("topic")
        self.count, self.name = int(options.get("partitions", 8)), options.get("writer", "")
        self.most = int(options.get("fileRecords", FILE_RECORDS))

    def _dealt(self, batch: pa.RecordBatch, keys: list[bytes | None]) -> np.ndarray:
        if "partition" in batch.schema.names:
            return batch.column("partition").to_numpy(zero_copy_only=False).astype(np.int64)
        return np.array([zlib.crc32(k or b"") % self.count for k in keys], np.int64)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder, out = Folder(self.path), Written(TaskContext.get().partitionId())
        folder.fs.create_dir(f"{folder.root}/data", recursive=True)
        open_files: dict[tuple[str, int], tuple[pq.ParquetWriter, Part]] = {}
        schema = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us", "UTC"))])
        for batch in iterator:
            now = pa.scalar(datetime.datetime.now(datetime.timezone.utc), schema.field("timestamp").type)
            rows = pa.table([batch.column("key").cast(pa.binary()) if "key" in batch.schema.names else pa.nulls(len(batch), pa.binary()),
                             batch.column("value").cast(pa.binary()), pa.repeat(now, len(batch))], schema=schema)
            topics = np.array(batch.column("topic").to_pylist() if self.topic is None else [self.topic] * len(batch), object)
            parts = self._dealt(batch, rows.column("key").to_pylist())
            for topic in dict.fromkeys(topics.tolist()):
                own = np.flatnonzero(topics == topic)
                order = own[np.argsort(parts[own], kind="stable")]
                for some in np.split(order, np.flatnonzero(np.diff(parts[order])) + 1):
                    place = (topic, int(parts[some[0]]))
                    if place not in open_files:
                        part = Part(*place, 0, f"{uuid.uuid4().hex}.parquet")
                        open_files[place] = pq.ParquetWriter(f"{folder.root}/data/{part.file}", schema, filesystem=folder.fs), part
                        out.parts.append(part)
                    file, part = open_files[place]
                    file.write_table(rows.take(pa.array(some)))
                    part.records += len(some)
                    if part.records >= self.most:
                        open_files.pop(place)[0].close()
        for file, _ in open_files.values():
            file.close()
        return out

    def _parts(self, messages: list) -> list[Part]:
        return [p for m in sorted((m for m in messages if m is not None), key=lambda m: m.task) for p in m.parts]

    def commit(self, messages: list, batchId: int | None = None) -> None:
        Folder(self.path).commit(self._parts(messages), self.name, batchId)

    def abort(self, messages: list, batchId: int | None = None) -> None:
        Folder(self.path).remove(self._parts(messages))


# --- reading --------------------------------------------------------------

@dataclass
class Range(InputPartition):
    """Records ``first`` to ``stop`` of a data file that begins at offset ``begin``."""

    topic: str
    partition: int
    begin: int
    first: int
    stop: int
    file: str


class Wanted:
    """The topic partitions a subscription names, and offsets asked for."""

    def __init__(self, options: dict):
        given = {k: options[k] for k in ("subscribe", "subscribePattern", "assign") if options.get(k)}
        if len(given) != 1:
            raise ValueError("give one of subscribe, subscribePattern and assign")
        self.names = [t.strip() for t in given["subscribe"].split(",")] if "subscribe" in given else None
        self.pattern = given.get("subscribePattern")
        self.pairs = {t: {str(p) for p in ps} for t, ps in json.loads(given["assign"]).items()} if "assign" in given else None

    def holds(self, topic: str, partition: str) -> bool:
        if self.names is not None:
            return topic in self.names
        if self.pattern is not None:
            return re.fullmatch(self.pattern, topic) is not None
        return partition in self.pairs.get(topic, ())

    def ends(self, folder: Folder) -> dict:
        """{topic: {partition: end}} now."""
        ends = folder.last()[1]["ends"]
        kept = {t: {p: n for p, n in ps.items() if self.holds(t, p)} for t, ps in ends.items()}
        return {t: ps for t, ps in kept.items() if ps}


def asked(text: str, ends: dict) -> dict:
    """The offsets that an option names, per partition of ``ends``; partitions it doesn't name start at the earliest."""
    if text in ("earliest", "latest"):
        return {t: {p: 0 if text == "earliest" else n for p, n in ps.items()} for t, ps in ends.items()}
    told = json.loads(text)
    find = {EARLIEST: lambda n: 0, LATEST: lambda n: n}
    out: dict = {}
    for t, ps in ends.items():
        for p, n in ps.items():
            offset = told.get(t, {}).get(p, EARLIEST)
            out.setdefault(t, {})[p] = min(find[offset](n) if offset in find else offset, n)
    return out


def ranges(folder: Folder, start: dict, end: dict, most: int) -> list[Range]:
    """Tasks for the records from ``start`` to ``end`` of each partition, by the entries of the log that name them."""
    found = []
    for _, path in folder.entries():
        for topic, partition, begin, records, file in folder.read(path)["files"]:
            low = max(begin, start.get(topic, {}).get(str(partition), 0))
            high = min(begin + records, end.get(topic, {}).get(str(partition), 0))
            found += [Range(topic, partition, begin, at, min(at + most, high), file) for at in range(low, high, most)]
    return found


def read_range(path: str, part: Range) -> Iterator[pa.RecordBatch]:
    folder = Folder(path)
    at = part.begin
    with pq.ParquetFile(f"{folder.root}/data/{part.file}", filesystem=folder.fs) as file:
        for batch in file.iter_batches(batch_size=8192):
            low, high = max(part.first - at, 0), min(part.stop - at, len(batch))
            if low < high:
                rows, n = batch.slice(low, high - low), high - low
                yield pa.RecordBatch.from_arrays([
                    rows.column("key"), rows.column("value"), pa.repeat(part.topic, n),
                    pa.array(np.full(n, part.partition, np.int32)), pa.array(np.arange(at + low, at + high, dtype=np.int64)),
                    rows.column("timestamp"), pa.array(np.zeros(n, np.int32))],
                    ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"])
            at += len(batch)
            if at >= part.stop:
                return


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.wanted = options["path"], Wanted(options)
        self.starting, self.ending = options.get("startingOffsets", "earliest"), options.get("endingOffsets", "latest")
        self.most = int(options.get("fileRecords", FILE_RECORDS))

    def partitions(self) -> list[Range]:
        folder = Folder(self.path)
        ends = self.wanted.ends(folder)
        return ranges(folder, asked(self.starting, ends), asked(self.ending, ends), self.most) or [Range("", 0, 0, 0, 0, "")]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(self.path, partition) if partition.file else iter(())


class StreamReader(DataSourceStreamReader):
    """Offsets are {topic: {partition: next offset}}; a partition that appears later starts at 0."""

    def __init__(self, options: dict):
        self.path, self.wanted = options["path"], Wanted(options)
        self.starting, self.limit = options.get("startingOffsets", "latest"), options.get("maxOffsetsPerTrigger")
        self.group, self.most = options.get("group"), int(options.get("fileRecords", FILE_RECORDS))
        if self.limit and not self.group:
            raise ValueError("maxOffsetsPerTrigger needs a group, under which the position is kept")
        self.planned: dict | None = None

    def _place(self, folder: Folder) -> str:
        return f"{folder.root}/groups/{self.group}.json"

    def initialOffset(self) -> dict:
        folder = Folder(self.path)
        start = asked(self.starting, self.wanted.ends(folder))
        if self.group:  # a new stream begins anew, whatever an earlier one of the group has read
            folder.put(self._place(folder), start)
        return start

    def latestOffset(self) -> dict:
        folder = Folder(self.path)
        ends = self.wanted.ends(folder)
        if not self.limit:
            return ends
        held = folder.fs.get_file_info(self._place(folder)).type != pafs.FileType.NotFound
        at = self.planned or (folder.read(self._place(folder)) if held else {})
        left = {(t, p): n - at.get(t, {}).get(p, 0) for t, ps in ends.items() for p, n in ps.items()}
        total, most = sum(left.values()), int(self.limit)
        if total <= most:
            return ends
        # Each partition gives in proportion to what it has left.
        out: dict = {t: dict(ps) for t, ps in at.items()}
        for (t, p), n in left.items():
            out.setdefault(t, {})[p] = at.get(t, {}).get(p, 0) + -(-n * most // total)
        return out

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.planned = end
        return ranges(Folder(self.path), start, end, self.most)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(self.path, partition)

    def commit(self, end: dict) -> None:
        if self.group:
            folder = Folder(self.path)
            folder.put(self._place(folder), end)


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("a topic is only added to; write with mode append")
        return Writer(self.options)

    def streamWriter(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options)
