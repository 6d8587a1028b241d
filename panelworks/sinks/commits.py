"""One commit for several outputs of a micro-batch.

A batch writes each of its outputs into a folder named by its number, then one record that
names them all.  The record is written beside its place and renamed into it, so it is there
as a whole or not at all.  Readers go by the records: what a crashed batch left behind is
not seen, and a replay of that batch replaces it.  A batch that has a record is not run again.

Each record also carries the state that the next batch starts from, so a batch reads one record
however long the stream has run.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.session import write_text


@dataclass(frozen=True)
class Record:
    """What a batch has written: rows per output name, and the state after it."""

    seq: int
    batch_id: int
    folder: int  # number in the names of its folders: the batch, or less than 0 for an end of a run
    outputs: dict[str, int] = field(default_factory=dict)
    state: dict = field(default_factory=dict)


class CommitLog:
    """Records below a folder on any file system, numbered from 0."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._paths(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _name(self, seq: int) -> str:
        return f"{self.path}/{seq:012d}.json"

    def latest(self) -> Record | None:
        if not self._files.exists(self._paths(self.path)):
            return None
        found = self._files.listStatus(self._paths(self.path))
        names = [f.getPath().getName() for f in found]
        last = max((n for n in names if n.endswith(".json")), default=None)
        if last is None:
            return None
        (text,) = self.spark.read.text(f"{self.path}/{last}", wholetext=True).first()
        return Record(**json.loads(text))

    def add(
        self, batch_id: int, outputs: dict[str, int], state: dict, folder: int | None = None
    ) -> Record:
        """Commit the outputs of a batch; fails if another writer was first."""
        last = self.latest()
        number = batch_id if folder is None else folder
        record = Record(0 if last is None else last.seq + 1, batch_id, number, outputs, state)
        try:
            write_text(self.spark, self._name(record.seq), json.dumps(asdict(record)))
        except FileExistsError:
            raise RuntimeError(f"{self.path} is written by another stream too") from None
        return record

    def records(self) -> DataFrame:
        """(seq, batch_id, folder, output, n) of all commits."""
        schema = "seq bigint, batch_id bigint, folder bigint, outputs map<string,bigint>"
        files = self.spark.read.schema(schema).option("pathGlobFilter", "*.json").json(self.path)
        return files.select("seq", "batch_id", "folder", F.explode("outputs").alias("output", "n"))


def commit_path(path: str) -> str:
    """Folder of the records that belong to an output path."""
    return f"{path.rstrip('/')}_commits"


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def commit_batch(
    log: CommitLog,
    batch_id: int,
    write: Callable[[Record | None], tuple[dict[str, int], dict]],
) -> Record | None:
    """Run ``write`` with the latest record and commit the rows per output and the state it
    returns; None, and nothing is written, if the batch was committed before."""
    last = log.latest()
    if last is not None and last.batch_id >= batch_id:
        return None
    return log.add(batch_id, *write(last))


def committed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    output: str,
    log_path: str | None = None,
    form: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The rows below ``path`` of batches that were committed, as ``output`` of the log."""
    log = CommitLog(spark, log_path or commit_path(path))
    if log.latest() is None:
        return spark.createDataFrame([], schema)
    ids = log.records().where((F.col("output") == output) & (F.col("n") > 0)).select("folder")
    folders = [batch_folder(path, r["folder"]) for r in ids.distinct().toLocalIterator()]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).options(**(options or {})).option("basePath", path)
    return reader.format(form).load(folders).select(*schema.fieldNames())
