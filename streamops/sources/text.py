"""Text files, one row per line (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Bounded text source: column ``value``, one row per line."""
    return spark.read.text(path)
