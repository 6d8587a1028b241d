"""A keyed, partitioned message log in a shared folder, as a Spark data source.

``panel_log`` stands where a broker would: messages of a key go to one partition and keep their
order, a stream reads by offsets per partition, and any number of readers follow on their own.
A partition is a folder of segments.  A segment's name tells its first offset and its size,
so offsets come from a listing and a reader opens just the segments that it needs.

Tasks write segments to a staging folder.  The commit on the driver numbers them and moves
them into place, in the order of tasks.  Segments carry the tag of their write; writing a tag
again moves only what is not there yet, so a replayed micro-batch adds nothing.  One
writer at a time may append.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceStreamWriter,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from panelworks.session import ship

FORMAT = "panel_log"
PARTITIONS = 8
# Messages that a reader hands over at once.
BATCH = 1000

_MESSAGE = pa.schema(
    [
        ("key", pa.string()),
        ("value", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
    ]
)


@dataclass(frozen=True)
class Segment:
    path: str
    first: int
    count: int
    tag: str

    @property
    def end(self) -> int:
        return self.first + self.count


class _Folder:
    """The log's files, on any file system that Arrow knows by its address."""

    def __init__(self, address: str):
        if address.startswith("file:/") and not address.startswith("file://"):
            address = "file://" + address.removeprefix("file:")
        self.files, self.root = pafs.FileSystem.from_uri(address.rstrip("/"))

    def partition(self, k: int) -> str:
        return f"{self.root}/p={k:05d}"

    def segments(self, k: int) -> list[Segment]:
        found = self.files.get_file_info(pafs.FileSelector(self.partition(k), allow_not_found=True))
        out = []
        for info in found:
            first, count, tag = info.base_name.removesuffix(".jsonl").split("-", 2)
            out.append(Segment(info.path, int(first), int(count), tag))
        return sorted(out, key=lambda s: s.first)

    def ends(self, partitions: int) -> dict[str, int]:
        return {
            str(k): max((s.end for s in self.segments(k)), default=0) for k in range(partitions)
        }


@dataclass
class _Slice(InputPartition):
    """Offsets [first, end) of a partition and the segments that hold them."""

    address: str
    partition: int
    first: int
    end: int
    segments: tuple[Segment, ...]


def _slices(address: str, first: dict[str, int], end: dict[str, int]) -> list[_Slice]:
    folder, out = _Folder(address), []
    for name, upto in sorted(end.items()):
        begin = first.get(name, 0)
        if upto > begin:
            held = [s for s in folder.segments(int(name)) if s.end > begin and s.first < upto]
            out.append(_Slice(address, int(name), begin, upto, tuple(held)))
    return out


def _messages(part: _Slice | None) -> Iterator[pa.RecordBatch]:
    if part is None:  # Spark's way to say that there are no partitions
        return
    files = _Folder(part.address).files
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _MESSAGE, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=_MESSAGE)

    for segment in part.segments:
        with io.BufferedReader(files.open_input_file(segment.path)) as lines:
            for place, line in enumerate(lines):
                offset = segment.first + place
                if part.first <= offset < part.end:
                    held.append((*json.loads(line), part.partition, offset))
                    if len(held) == BATCH:
                        yield batch()
                        held = []
    if held:
        yield batch()


class _Reader(DataSourceReader):
    def __init__(self, address: str, partitions: int):
        self.address, self.count = address, partitions

    def partitions(self) -> Sequence[InputPartition]:
        return _slices(self.address, {}, _Folder(self.address).ends(self.count))

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _messages(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are messages per partition.

    With a limit a trigger takes so many messages at most, evenly over the partitions.  Spark does
    not tell a source where the last run ended, so a limited reader has a name and notes
    below the log how far it has planned, before it says so.  The first trigger after a crash
    may take up to twice the limit; nothing is skipped or read again.
    """

    def __init__(self, address: str, partitions: int, limit: int | None, reader: str | None):
        if limit and not reader:
            raise ValueError("a limited reader needs a name: option reader")
        self.address, self.count, self.limit, self.reader = address, partitions, limit, reader

    def _note(self) -> tuple[pafs.FileSystem, str]:
        folder = _Folder(self.address)
        return folder.files, f"{folder.root}/_readers/{self.reader}.json"

    def _planned(self) -> dict[str, int]:
        files, note = self._note()
        if files.get_file_info(note).type == pafs.FileType.NotFound:
            return {str(k): 0 for k in range(self.count)}
        with files.open_input_stream(note) as held:
            return json.loads(held.read())

    def initialOffset(self) -> dict:
        return {str(k): 0 for k in range(self.count)}

    def latestOffset(self) -> dict:
        ends = _Folder(self.address).ends(self.count)
        if not self.limit:
            return ends
        ends = self._limited(self._planned(), ends)
        files, note = self._note()
        files.create_dir(note.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(f"{note}.part") as out:
            out.write(json.dumps(ends).encode())
        files.move(f"{note}.part", note)
        return ends

    def _limited(self, done: dict[str, int], ends: dict[str, int]) -> dict[str, int]:
        waiting = {k: ends[k] - done.get(k, 0) for k in ends if ends[k] > done.get(k, 0)}
        left, out = self.limit, dict(done)
        for place, (k, n) in enumerate(sorted(waiting.items(), key=lambda x: x[1])):
            share = min(n, left // (len(waiting) - place))
            out[k] = done.get(k, 0) + share
            left -= share
        return out

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return _slices(self.address, start, end)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _messages(partition)


@dataclass
class _Staged(WriterCommitMessage):
    """Files that a task has written: (partition, messages, path)."""

    files: tuple[tuple[int, int, str], ...]


class _Write:
    """What the batch and the stream writer share; rows are (key, value, partition)."""

    def __init__(self, address: str, tag: str):
        self.address, self.tag = address, tag
        self.staging = f"_staging/{uuid.uuid4().hex}"

    def write(self, iterator) -> _Staged:
        folder = _Folder(self.address)
        where = f"{folder.root}/{self.staging}"
        folder.files.create_dir(where, recursive=True)
        open_: dict[int, list] = {}
        for row in iterator:
            if row["partition"] not in open_:
                path = f"{where}/{row['partition']}-{uuid.uuid4().hex}"
                open_[row["partition"]] = [folder.files.open_output_stream(path), 0, path]
            entry = open_[row["partition"]]
            entry[0].write(json.dumps([row["key"], row["value"]]).encode() + b"\n")
            entry[1] += 1
        for out, _, _ in open_.values():
            out.close()
        return _Staged(tuple((k, n, path) for k, (_, n, path) in open_.items()))

    def publish(self, messages: Sequence[_Staged | None], tag: str) -> None:
        folder = _Folder(self.address)
        staged: dict[int, list[tuple[int, str]]] = {}
        for message in messages:
            for k, n, path in message.files if message else ():
                staged.setdefault(k, []).append((n, path))
        for k, files in sorted(staged.items()):
            there = folder.segments(k)
            tags = {s.tag for s in there}
            first = max((s.end for s in there), default=0)
            folder.files.create_dir(folder.partition(k), recursive=True)
            for number, (n, path) in enumerate(files):
                own = f"{tag}.{number}"
                if own not in tags:
                    target = f"{folder.partition(k)}/{first:019d}-{n}-{own}.jsonl"
                    folder.files.move(path, target)
                    first += n
        self.discard()

    def discard(self) -> None:
        folder = _Folder(self.address)
        folder.files.delete_dir(f"{folder.root}/{self.staging}")


class _Writer(_Write, DataSourceWriter):
    def commit(self, messages) -> None:
        self.publish(messages, self.tag)

    def abort(self, messages) -> None:
        self.discard()


class _StreamWriter(_Write, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        self.publish(messages, f"{self.tag}.{batchId}")

    def abort(self, messages, batchId: int) -> None:
        self.discard()


class PanelLog(DataSource):
    """Options: path, partitions, tag (of a write), limit (messages per trigger) and reader (the
    name of who reads with a limit)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "key string, value string, partition int, offset bigint"

    def _address(self) -> str:
        return self.options["path"]

    def _count(self) -> int:
        return int(self.options.get("partitions", PARTITIONS))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self._address(), self._count())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        limit = int(self.options.get("limit", 0)) or None
        return _StreamReader(self._address(), self._count(), limit, self.options.get("reader"))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self._address(), self.options.get("tag", uuid.uuid4().hex))

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return _StreamWriter(self._address(), self.options.get("tag", "stream"))


def register(spark: SparkSession) -> None:
    """Make the format known to the session and its workers."""
    ship(spark)
    spark.dataSource.register(PanelLog)


def partition_of(key: Column, partitions: int = PARTITIONS) -> Column:
    return F.pmod(F.crc32(F.coalesce(key, F.lit(""))), F.lit(partitions)).cast("int")


def write_log(
    messages: DataFrame,
    path: str,
    order: Sequence[str],
    partitions: int = PARTITIONS,
    tag: str | None = None,
) -> None:
    """Append messages (key, value and the columns of ``order``) to a log.

    Messages of a key are in the order given.  Writing a ``tag`` a second time adds nothing.
    """
    register(messages.sparkSession)
    dealt = (
        messages.withColumn("partition", partition_of(F.col("key"), partitions))
        .repartition(partitions, "partition")
        .sortWithinPartitions("partition", *order)
        .select("key", "value", "partition")
    )
    writer = dealt.write.format(FORMAT).mode("append").option("path", path)
    (writer.option("tag", tag) if tag else writer).save()


def read_log(spark: SparkSession, path: str, partitions: int = PARTITIONS) -> DataFrame:
    """All messages of a log: key, value, partition, offset."""
    register(spark)
    return spark.read.format(FORMAT).option("partitions", partitions).load(path)


def log_stream(
    spark: SparkSession,
    path: str,
    partitions: int = PARTITIONS,
    limit: int | None = None,
    reader: str | None = None,
) -> DataFrame:
    """The log as a stream from its first message on; a checkpoint keeps the offsets.

    With ``limit`` messages per trigger the reader needs a name, one per checkpoint.
    """
    register(spark)
    stream = spark.readStream.format(FORMAT).option("partitions", partitions)
    if limit:
        stream = stream.option("limit", limit)
    if reader:
        stream = stream.option("reader", reader)
    return stream.load(path)
