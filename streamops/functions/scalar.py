"""Scalar functions the reference uses: abs, Java modulo, min/max, concat,
to-string and millisecond timestamp formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamops.sources.tables import millis_to_ntz

# Fixed value: the reference's timestamp format.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def format_millis(col: str | Column) -> Column:
    """Render epoch ms as ``yyyy-MM-dd HH:mm:ss.SSS`` in UTC (zone-free)."""
    return F.date_format(millis_to_ntz(col), TS_FORMAT)


def java_mod(a: Column, n: int) -> Column:
    """``a % n`` with the sign of the dividend, as Java and Spark ``%`` do."""
    return a % F.lit(n)


def scalar_bundle(sensor: DataFrame, pivot: int = 250, cap: int = 100) -> DataFrame:
    vc = F.col("vc")
    return sensor.select(
        "arrival",
        F.abs(vc - F.lit(pivot)).alias("abs_diff"),
        java_mod(vc - F.lit(pivot), 7).alias("mod7"),
        F.concat(F.lit("id:"), F.col("id"), F.lit("/"), vc.cast("string")).alias("label"),
        format_millis("ts_ms").alias("ts_text"),
        F.least(vc, F.lit(cap)).alias("lo"),
        F.greatest(vc, F.lit(cap)).alias("hi"),
    )
