"""Physical distribution (P1-P8).  These change placement, never the row set
(except ``broadcast_copies``, which copies every row ``n`` times)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shuffle_width(df: DataFrame) -> int:
    """The session's number of shuffle partitions, the default of ``n``."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def random_partition(df: DataFrame, n: int | None = None, seed: int = 17) -> DataFrame:
    """Random placement that is still deterministic: a seeded hash of the
    whole row and of its place in its input partition, so equal rows spread
    too.  ``rand()`` would place a recomputed row elsewhere after an executor
    loss and force downstream stages to rerun; the place is the same whenever
    the input partition is read again (files are)."""
    at = "_place"
    return (df.withColumn(at, F.monotonically_increasing_id())
              .repartition(n or shuffle_width(df), F.xxhash64(F.lit(seed), *[F.col(c) for c in [*df.columns, at]]))
              .drop(at))


def round_robin(df: DataFrame, n: int | None = None) -> DataFrame:
    return df.repartition(n or shuffle_width(df))


def rescale(df: DataFrame, n: int | None = None) -> DataFrame:
    """Merge neighbouring partitions without a shuffle, down to ``n``, by
    default half the session's shuffle partitions: the scan below runs in as
    many tasks, so ``n`` must grow with the input."""
    return df.coalesce(n or max(1, shuffle_width(df) // 2))


def broadcast_copies(df: DataFrame, n: int) -> DataFrame:
    """One copy of every row per downstream task, tagged with ``copy``.

    A generator (explode) rather than a join: no pair enumeration.
    """
    return df.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("copy"), "*")


def single_partition(df: DataFrame) -> DataFrame:
    """Everything to the first task.  Only for results of bounded size (for
    example a per-type summary); never for raw input."""
    return df.coalesce(1)


def by_key(df: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """All rows of a key in one partition, by definition; a hot key is one
    task's rows, so use it for placement and aggregate without it."""
    return df.repartition(n or shuffle_width(df), *keys)


def custom_partition_id(key: str, n: int) -> Column:
    """``parseInt(key) % n`` made non-negative (``pmod``); a key that is not an
    integer goes to partition 0."""
    return F.coalesce(F.pmod(F.col(key).try_cast("bigint"), F.lit(n)), F.lit(0)).cast("int")


def custom_partition(df: DataFrame, key: str, n: int) -> DataFrame:
    """Place each row in partition ``pmod(int(key), n)`` exactly."""
    return df.repartitionById(n, custom_partition_id(key, n))


def with_partition_id(df: DataFrame, col: str = "pid") -> DataFrame:
    return df.withColumn(col, F.spark_partition_id())
