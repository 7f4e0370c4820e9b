"""Custom sinks with a two-phase commit (K5; exactly-once for K1 and K2).

A writer of the user's is opened in each task, gets the task's rows one after
another and is closed; what ``close`` returns is the task's commit message.  The
rows are only staged by then.  When all tasks of a batch are done, ``commit``
runs once on the driver with all messages; when one fails, ``abort`` runs with
the messages of those that had ended.  A batch that is run again after its commit
(a crash before Spark wrote it down) is recognised by its id, and its new staged
rows are dropped: no row is lost, none comes twice.

``committed_lines`` is the sink for text lines: staged files in a shared folder,
and a manifest for each batch, put in place by one rename, that makes its files
visible to ``read_committed``."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage


class TaskWriter(Protocol):
    """The user's writer of one task."""

    def open(self, partition_id: int) -> None: ...

    def write(self, row) -> None: ...

    def close(self) -> Any:
        """Stage what was written; the value is the commit message."""

    def discard(self) -> None:
        """The task failed: drop what was written."""


@dataclass
class Staged(WriterCommitMessage):
    partition_id: int
    value: Any


class _Writer(DataSourceStreamWriter):
    def __init__(self, factory, commit, abort):
        self.factory, self.on_commit, self.on_abort = factory, commit, abort

    def write(self, iterator: Iterator) -> Staged:
        from pyspark import TaskContext
        partition_id = TaskContext.get().partitionId()
        w = self.factory()
        w.open(partition_id)
        try:
            for row in iterator:
                w.write(row)
            return Staged(partition_id, w.close())
        except BaseException:
            w.discard()
            raise

    def commit(self, messages, batchId: int) -> None:
        self.on_commit([m.value for m in messages if m is not None], batchId)

    def abort(self, messages, batchId: int) -> None:
        self.on_abort([m.value for m in messages if m is not None], batchId)


def two_phase_sink(name: str, factory: Callable[[], TaskWriter], commit: Callable[[list, int], None],
                   abort: Callable[[list, int], None]) -> type[DataSource]:
    """A sink to register with ``spark.dataSource.register``; ``commit`` and
    ``abort`` get the messages of a batch's tasks and its id, and must do nothing
    new for an id that they have committed."""

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
            return _Writer(factory, commit, abort)

    return Sink


# --- text lines -----------------------------------------------------------------

def _files(root: str) -> tuple[pafs.FileSystem, str]:
    if "://" in root:
        return pafs.FileSystem.from_uri(root)
    return pafs.LocalFileSystem(), root.removeprefix("file:")


class LineWriter:
    """Stages the column ``value`` of its rows as lines of one file."""

    def __init__(self, root: str):
        self.root, self.out, self.rows = root, None, 0

    def open(self, partition_id: int) -> None:
        fs, base = _files(self.root)
        self.name = f"lines/{partition_id:05d}-{uuid.uuid4().hex}.txt"
        fs.create_dir(f"{base}/lines", recursive=True)
        self.out = fs.open_output_stream(f"{base}/{self.name}")

    def write(self, row) -> None:
        self.out.write((row["value"] if row["value"] is not None else "").encode() + b"\n")
        self.rows += 1

    def close(self) -> dict:
        self.out.close()
        return {"file": self.name, "rows": self.rows}

    def discard(self) -> None:
        fs, base = _files(self.root)
        self.out.close()
        fs.delete_file(f"{base}/{self.name}")


def _drop(root: str, messages: list) -> None:
    fs, base = _files(root)
    for m in messages:
        if fs.get_file_info(f"{base}/{m['file']}").type != pafs.FileType.NotFound:
            fs.delete_file(f"{base}/{m['file']}")


def committed_lines(root: str) -> type[DataSource]:
    """The sink ``committed_lines`` over the shared folder ``root``: lines with
    line breaks in them are not split again (one row, one or more lines)."""

    def commit(messages: list, batch_id: int) -> None:
        fs, base = _files(root)
        manifest = f"{base}/manifests/{batch_id:012d}"
        if fs.get_file_info(manifest).type != pafs.FileType.NotFound:
            _drop(root, messages)                      # run again after its commit
            return
        fs.create_dir(f"{base}/manifests", recursive=True)
        aside = f"{base}/manifests/.{batch_id:012d}-{uuid.uuid4().hex}"
        with fs.open_output_stream(aside) as f:
            f.write(json.dumps(messages).encode())
        fs.move(aside, manifest)

    def abort(messages: list, batch_id: int) -> None:
        _drop(root, messages)

    return two_phase_sink("committed_lines", lambda: LineWriter(root), commit, abort)


def read_committed(spark: SparkSession, root: str) -> DataFrame:
    """The lines of all committed batches, column ``value``."""
    manifests = spark.read.text(f"{root.rstrip('/')}/manifests", wholetext=True).collect()
    names = [f"{root.rstrip('/')}/{m['file']}" for r in manifests for m in json.loads(r["value"]) if m["rows"]]
    return spark.read.text(names) if names else spark.createDataFrame([], "value string")


def write_committed_lines(lines: DataFrame, root: str, checkpoint: str, **trigger):
    """Start a query that writes the column ``value`` of a stream exactly once."""
    lines.sparkSession.dataSource.register(committed_lines(root))
    out = lines.select("value").writeStream.format("committed_lines").option("checkpointLocation", checkpoint)
    return (out.trigger(**trigger) if trigger else out).start()
