"""Sinks (K1-K6): row shaping for Kafka, file, JDBC, custom and console sinks.

Spark's Kafka sink is at-least-once; rows carry a ``dedup_id`` so a consumer
can drop replays.  The JDBC and Parquet writers are safe to replay by batch id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamops.sources.tables import millis_to_ntz
from streamops.streaming import store

# Fixed value: the hourly directory format of the file sink.
HOUR_DIR_FORMAT = "yyyy-MM-dd HH"
#: The file that marks a whole batch.
WHOLE = "_whole"


def kafka_value_rows(lines: DataFrame, value_col: str = "value", id_col: str | None = None) -> DataFrame:
    """Value-only records; ``dedup_id`` is a stable id for at-least-once replays."""
    cols = [F.col(value_col).cast("string").alias("value")]
    if id_col:
        cols.append(F.col(id_col).cast("string").alias("dedup_id"))
    return lines.select(*cols)


def kafka_keyed_rows(lines: DataFrame, topic: str, value_col: str = "value") -> DataFrame:
    """Key = first comma field of the line, value = the whole line."""
    v = F.col(value_col)
    return lines.select(F.lit(topic).alias("topic"), F.split(v, ",").getItem(0).alias("key"), v.alias("value"))


def kafka_records(rows: DataFrame) -> DataFrame:
    """The columns the Kafka sink takes: ``key``, ``value``, ``topic`` when
    present, and a ``dedup_id`` record header when the rows carry one."""
    out = rows
    if "dedup_id" in rows.columns:
        out = rows.withColumn("headers", F.array(F.struct(F.lit("dedup_id").alias("key"),
                                                          F.col("dedup_id").cast("binary").alias("value"))))
    return out.select(*[c for c in ("key", "value", "topic", "headers") if c in out.columns])


def kafka_stream_sink(rows: DataFrame, bootstrap: str, topic: str | None, checkpoint: str,
                      trigger: str = "2 seconds", **extra):
    """Kafka sink (K2/K3): ``rows`` has ``value`` and optionally ``key`` /
    ``topic``.  At-least-once; consumers drop replays by ``dedup_id``, which is
    sent as a record header."""
    out = kafka_records(rows)
    opts = {"kafka.bootstrap.servers": bootstrap, "checkpointLocation": checkpoint}
    if topic:
        opts["topic"] = topic
    opts.update(extra)
    return out.writeStream.format("kafka").options(**opts).trigger(processingTime=trigger).start()


def with_hour_bucket(df: DataFrame, time_ms: str = "ts_ms") -> DataFrame:
    """Directory bucket from the event hour (deterministic, unlike wall clock)."""
    return df.withColumn("bucket_hour", F.date_format(millis_to_ntz(time_ms), HOUR_DIR_FORMAT))


def write_text_by_hour(df: DataFrame, path: str, value_col: str = "value", max_records_per_file: int = 1_000_000) -> None:
    """Batch row-format text sink: one folder per event hour, files rolled by a
    record cap.  Rows are dealt by ranges of (hour, hash of the line, input
    task): ranges hold alike many rows, so small hours share a task, an hour with
    a third of all rows is written by a third of the tasks, and an hour gives
    about as many files as tasks that hold it (and those that the cap rolls)."""
    rows = df.select(value_col, "bucket_hour")
    dealt = rows.repartitionByRange(F.col("bucket_hour"), F.xxhash64(value_col), F.spark_partition_id())
    (dealt.sortWithinPartitions("bucket_hour").write.mode("errorifexists").option("maxRecordsPerFile", max_records_per_file)
          .partitionBy("bucket_hour").text(path))


def read_text_by_hour(spark, path: str) -> DataFrame:
    return spark.read.schema("value string, bucket_hour string").text(path)


def stream_text_by_hour(df: DataFrame, path: str, checkpoint: str, trigger: str = "2 seconds",
                        max_records_per_file: int = 1_000_000):
    """Streaming file sink: exactly-once through the checkpoint and the file
    sink log; rolling by trigger interval and record cap."""
    return (df.select("value", "bucket_hour").writeStream.format("text")
              .option("checkpointLocation", checkpoint)
              .option("maxRecordsPerFile", max_records_per_file)
              .partitionBy("bucket_hour").trigger(processingTime=trigger).start(path))


def jdbc_delete_batch(spark, url: str, table: str, properties: dict, batch_id: int) -> None:
    """Delete a batch's rows, in one transaction; a table that does not exist
    has none."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    con = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        found = con.getMetaData().getTables(None, None, table.split(".")[-1], None)
        if found.next():
            con.createStatement().executeUpdate(f"DELETE FROM {table} WHERE batch_id = {int(batch_id)}")
    finally:
        con.close()


def jdbc_append(rows: DataFrame, url: str, table: str, properties: dict, batch_size: int) -> None:
    rows.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=properties)


def jdbc_batch_writer(url: str, table: str, properties: dict, batch_size: int = 100, retries: int = 3,
                      delete=jdbc_delete_batch, append=jdbc_append):
    """``foreachBatch`` function writing each micro-batch with JDBC batching.

    Every row carries its batch id.  Each attempt first deletes what the table
    holds of that id, then appends the batch, so neither a retry nor a replay
    after partitions were committed loses or doubles rows; between the two a
    reader can see part of a batch.  The last error is raised when the retries
    are used up, so the batch is not taken as written.  Credentials come from
    ``properties`` only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        for attempt in range(retries + 1):
            try:
                delete(batch.sparkSession, url, table, properties, batch_id)
                append(rows, url, table, properties, batch_size)
                return
            except Exception:
                if attempt == retries:
                    raise

    return write


def idempotent_parquet_sink(path: str):
    """``foreachBatch`` writer that is safe to replay, for its readers too:
    batch N is written aside, with a mark that it is whole, and published as
    ``path/batch_id=N`` by one rename.

    A published batch is never written again, whenever the replay comes, so a
    stream that reads ``path`` sees each file once; what a failed attempt left
    lies in a hidden folder, and a folder without the mark is replaced."""
    root = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, final = batch.sparkSession, f"{root}/batch_id={int(batch_id)}"
        if store.exists(spark, f"{final}/{WHOLE}"):
            return
        attempt = f"{root}/_attempts/{int(batch_id)}-{uuid.uuid4().hex}"
        batch.write.parquet(attempt)
        store.write_text(spark, f"{attempt}/{WHOLE}", "")
        store.remove(spark, final)
        store.move(spark, attempt, final)

    return write


class ForeachRowSink:
    """Custom sink with open / process / close, for ``writeStream.foreach``.

    ``factory(partition_id, epoch_id)`` returns a writer object with
    ``write(row)`` and ``close()``; ``close`` runs even after an error.
    """

    def __init__(self, factory):
        self.factory = factory
        self.writer = None

    def open(self, partition_id, epoch_id):
        self.writer = self.factory(partition_id, epoch_id)
        return True

    def process(self, row):
        self.writer.write(row)

    def close(self, error):
        if self.writer is not None:
            self.writer.close()


def console(df: DataFrame, label: str, checkpoint: str, mode: str = "append"):
    """Labelled console output on stdout (print)."""
    return (df.writeStream.format("console").queryName(label).outputMode(mode)
              .option("checkpointLocation", checkpoint).start())


def console_err(df: DataFrame, label: str, checkpoint: str):
    """Labelled per-row output on the executors' stderr (printToErr)."""

    def emit(row):
        import sys as _sys
        print(f"{label}> {row}", file=_sys.stderr)

    return (df.writeStream.foreach(emit).queryName(label)
              .option("checkpointLocation", checkpoint).start())
