"""Streaming sources (S3-S8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.sources.tables import sensor_view


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Line-per-row file source (S3/S4), column ``value``; no watermark (S8)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Socket lines (S5), for manual testing only; no tests open a port."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def kafka_options(bootstrap: str, topic: str, group_id: str | None = None,
                  starting: str = "latest", **extra) -> dict:
    """Options of the Kafka source (S6): brokers, topic, group id, start."""
    o = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if group_id:
        o["kafka.group.id"] = group_id
    o.update(extra)
    return o


def decode_kafka_value(df: DataFrame) -> DataFrame:
    """Value-only string decoding of Kafka records."""
    return df.select(F.col("value").cast("string").alias("value"))


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """Needs the Kafka connector on the classpath (not bundled here)."""
    return decode_kafka_value(spark.readStream.format("kafka").options(**options).load())


def header_id(df: DataFrame, name: str = "dedup_id") -> DataFrame:
    """Adds ``dedup_id`` from the record header that ``sinks.kafka_records``
    writes (the source option ``includeHeaders`` gives the headers); NULL where a
    record has none."""
    of_name = F.filter("headers", lambda h: h["key"] == name)
    return df.withColumn("dedup_id", F.get(of_name, F.lit(0))["value"].cast("string"))


def consume_once(stream: DataFrame, id_col: str = "dedup_id", time_col: str = "event_time", within: str = "1 hour") -> DataFrame:
    """The consumer's side of an at-least-once sink: the first record of each id
    (K2).  A copy comes within ``within`` of the first in event time; ids older
    than that leave the state, so it holds those of about twice that span.
    Records without an id are all kept."""
    marked = stream.withWatermark(time_col, within).withColumn(
        "_once", F.coalesce(F.concat(F.lit("i"), F.col(id_col)), F.concat(F.lit("r"), F.expr("uuid()"))))
    return marked.dropDuplicatesWithinWatermark(["_once"]).drop("_once")


def events_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """A parquet folder of ``events`` files read as a stream, as sensor rows."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    return sensor_view(raw)


def with_event_time(df: DataFrame, time_ms: str = "ts_ms") -> DataFrame:
    """``event_time TIMESTAMP`` for ``withWatermark`` (which refuses NTZ)."""
    return df.withColumn("event_time", F.timestamp_millis(F.col(time_ms)))
