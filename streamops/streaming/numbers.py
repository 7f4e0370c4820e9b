"""Paced number generator as a streaming source of its own (S7).

``Number:i`` for i in [0, n), at most ``rowsPerSecond`` a second since the
source first started, read by ``readers`` tasks.  An offset is the count of
numbers given out, so a batch is a range: it is read again after a failure as it
was the first time, and a query that goes on from its checkpoint gives each
number once.  The first start's time is kept in a folder, so a restart goes on at
the same pace (what came due in the meantime comes at once)."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from streamops.streaming import store

SCHEMA = "i bigint, value string"
#: Numbers of one Arrow batch.
BATCH = 10_000


@dataclass
class Numbers(InputPartition):
    """The numbers first <= i < end."""

    first: int
    end: int


class PacedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.n, self.rate = int(options["n"]), float(options.get("rowsPerSecond", 5))
        self.readers, self.start = max(1, int(options.get("readers", 1))), int(options["startMs"])
        self.most = 0
        if self.n < 0 or self.rate <= 0:
            raise ValueError("n must not be negative, rowsPerSecond must be positive")

    def initialOffset(self) -> dict:
        return {"at": 0}

    def latestOffset(self) -> dict:
        due = int((time.time() * 1000 - self.start) * self.rate / 1000)
        self.most = min(self.n, max(self.most, due))   # a clock that is set back takes nothing back
        return {"at": self.most}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        a, z = start["at"], max(start["at"], end["at"])
        self.most = max(self.most, z)
        edges = [a + (z - a) * k // self.readers for k in range(self.readers + 1)]
        return [Numbers(x, y) for x, y in zip(edges, edges[1:]) if x < y]

    def read(self, partition: Numbers) -> Iterator[pa.RecordBatch]:
        for a in range(partition.first, partition.end, BATCH):
            i = range(a, min(a + BATCH, partition.end))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array([f"Number:{x}" for x in i])], names=["i", "value"])

    def commit(self, end: dict) -> None:
        pass


class PacedNumbers(DataSource):
    """Options: n, rowsPerSecond, readers, startMs (the first start, epoch ms)."""

    @classmethod
    def name(cls) -> str:
        return "paced_numbers"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> PacedReader:
        return PacedReader(self.options)


def paced_numbers(spark: SparkSession, n: int, folder: str, rows_per_second: float = 5, readers: int = 1) -> DataFrame:
    """The stream of numbers; ``folder`` (the query's own) keeps the first start."""
    path = f"{folder.rstrip('/')}/first-start"
    started = store.read_text(spark, path)
    if started is None:
        started = str(int(time.time() * 1000))
        store.write_text(spark, path, started)
    spark.dataSource.register(PacedNumbers)
    return (spark.readStream.format("paced_numbers").option("n", n).option("rowsPerSecond", rows_per_second)
                 .option("readers", readers).option("startMs", started).load())
