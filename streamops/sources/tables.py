"""Read the parquet tables and derive the canonical sensor views.

The sensor reading is ``(id STRING, ts_ms BIGINT, vc INT)`` plus an explicit
``arrival`` order column.  All conversions from TIMESTAMP_NTZ are done with
integer arithmetic so they do not depend on the session time zone.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the jittered arrival order (FIXTURES.md section 3): the
# multiplier, the modulus and the step of the synthetic delay.
JITTER_MULT = 7919
JITTER_MOD = 13
JITTER_STEP_MS = 300_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ntz_to_millis(col: str) -> Column:
    """Epoch milliseconds (floor) of a TIMESTAMP_NTZ column, zone-free."""
    us = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)"
    return F.expr(f"({us} - pmod({us}, 1000)) div 1000")


def millis_to_ntz(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MILLISECOND", c, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def sensor_view(events: DataFrame) -> DataFrame:
    """events -> sensor(id, ts_ms, vc, arrival, event_type)."""
    return events.select(
        F.col("user_id").cast("string").alias("id"),
        ntz_to_millis("ts").alias("ts_ms"),
        F.floor("value").cast("int").alias("vc"),
        F.col("event_id").alias("arrival"),
        "event_type",
    )


def sensor(spark: SparkSession, sf_dir: str, id_equals: str | None = None) -> DataFrame:
    """The sensor view; ``id_equals`` keeps one id.

    ``id`` is ``cast(user_id as string)``, which Catalyst cannot invert, so a
    filter on it would not reach the parquet scan.  For a canonical integer
    text the equivalent ``user_id = n`` filter is applied to the raw column
    (pushed down, row groups skipped by statistics); the string filter stays
    as well, so non-canonical texts keep their exact meaning."""
    ev = read_table(spark, sf_dir, "events")
    if id_equals is not None and re.fullmatch(r"0|-?[1-9][0-9]{0,17}", id_equals):
        ev = ev.where(F.col("user_id") == F.lit(int(id_equals)))
    s = sensor_view(ev)
    return s if id_equals is None else s.where(F.col("id") == F.lit(id_equals))


def with_jitter(sensor_df: DataFrame) -> DataFrame:
    """Add ``arr_ms``: a synthetic arrival time that is out of event-time order.

    The arrival order is ``(arr_ms, arrival)``; it is unique because
    ``arrival`` is.
    """
    delay = F.pmod(F.col("arrival") * JITTER_MULT, F.lit(JITTER_MOD)) * JITTER_STEP_MS
    return sensor_df.withColumn("arr_ms", F.col("ts_ms") + delay)


def lines_view(documents: DataFrame) -> DataFrame:
    """documents -> lines(doc_id, line_no (1-based), value)."""
    return documents.select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "value")
    ).select("doc_id", (F.col("pos") + 1).cast("bigint").alias("line_no"), "value")


def sensor_lines(sensor_df: DataFrame) -> DataFrame:
    """Sensor rows rendered as ``id,ts,vc`` text lines."""
    return sensor_df.select(
        F.lit("events").alias("source"),
        F.col("arrival").alias("rec"),
        F.lit(0).cast("bigint").alias("pos"),
        F.concat_ws(",", "id", F.col("ts_ms").cast("string"), F.col("vc").cast("string")).alias("value"),
    )


def candidate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sensor line plus every document line: the input of the parser.

    Document lines are mostly not sensor readings, so they exercise the
    quarantine path on real text.
    """
    docs = lines_view(read_table(spark, sf_dir, "documents")).select(
        F.lit("documents").alias("source"), F.col("doc_id").alias("rec"),
        F.col("line_no").alias("pos"), "value")
    return sensor_lines(sensor(spark, sf_dir)).unionByName(docs)
