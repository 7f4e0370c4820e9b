"""Paced number generator (S7): ``Number:i`` for i in [0, n)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def number_text(i: Column) -> Column:
    return F.concat(F.lit("Number:"), i.cast("string"))


def generate(spark: SparkSession, n: int, parts: int | None = None, fn=number_text) -> DataFrame:
    """Bounded form: ``spark.range`` split into ``parts`` partitions."""
    return spark.range(0, n, 1, parts).select(F.col("id").alias("i"), fn(F.col("id")).alias("value"))


def generate_stream(spark: SparkSession, n: int, rows_per_second: int = 5, parts: int | None = None,
                    fn=number_text) -> DataFrame:
    """Unbounded rate source capped at ``n`` values (the paced form)."""
    src = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if parts:
        src = src.option("numPartitions", parts)
    return src.load().where(F.col("value") < n).select(F.col("value").alias("i"), fn(F.col("value")).alias("value"))
