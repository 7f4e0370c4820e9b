"""Rolling keyed aggregates (A1-A7): one output row per input row carrying the
running value of its key, in arrival order.

All order-dependent forms go through ``prefix_scan`` so a hot key is split
into arrival chunks instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamops.plans.scan import Agg, chunk_for, chunked, prefix_scan

#: Keys share so many slots where their rows are counted beforehand.
SLOTS = 1 << 16
#: A slot is heavy with more than this share of the rows, or with so many rows.
HEAVY_SHARE = 1 / 256
HEAVY_ROWS = 1_000_000
#: With more heavy slots than this, every key is cut.
HEAVY_SLOTS = 4096
#: Chunk of the keys that are not cut.
UNCUT = -(1 << 62)


def wordcount(tokens: DataFrame, word_col: str = "word") -> DataFrame:
    """Bounded word count: partial count per task, one exchange on the word."""
    return tokens.groupBy(word_col).agg(F.count(F.lit(1)).alias("cnt"))


def running_count(df: DataFrame, keys: list[str], order: list[str], chunk_col: str,
                  width: int | None = None, name: str = "cnt", reuse_input: bool = False,
                  chunk: Column | None = None) -> DataFrame:
    """Running number of rows per key (1, 2, 3, ...) along ``order``.
    ``reuse_input`` reads an expensive input (e.g. tokenised text) once;
    ``chunk`` gives its chunk numbers where they come from another table."""
    chunk = chunk if chunk is not None else chunk_for(df, chunk_col, width)
    return prefix_scan(df, keys, order, chunk, [Agg(name, "count", F.lit(1))], reuse_input=reuse_input)


def heavy_slots(df: DataFrame, slot: Column) -> list[int]:
    """The slots with many rows, by a count of all rows of ``df``."""
    sizes = df.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))        # at most SLOTS rows
    least = F.least(F.sum("n").over(Window.partitionBy()) * HEAVY_SHARE, F.lit(HEAVY_ROWS))
    return sorted(r["slot"] for r in sizes.withColumn("least", least).where("n > least").select("slot").collect())


def running_count_uneven(df: DataFrame, key: str, order: list[str], chunk: Column) -> DataFrame:
    """``running_count`` for many keys of which few have many rows (words).

    Only the keys of heavy slots are cut into chunks, and only their chunks have
    totals and a carry; the rows of any other key, ``HEAVY_ROWS`` at most, are
    one chunk.  The slots decide where a row is counted, not what is counted: a
    light key in a heavy slot is cut as well."""
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS))
    heavy = heavy_slots(df, slot)
    if len(heavy) <= HEAVY_SLOTS:
        chunk = F.when(slot.isin(heavy), chunk).otherwise(F.lit(UNCUT))
    ch = chunked(df, [key], order, chunk, [], df.columns, by_hash=True)
    rows = ch.rows.select("*", F.row_number().over(ch.window).cast("bigint").alias("_w"))
    # the uncut keys of a task share one row of its totals, whose names are null and meet none in the join
    cut = F.col("_chunk") != UNCUT
    alike = F.bit_xor(F.hash(*ch.rows.columns))
    totals = ch.rows.groupBy(*[F.when(cut, F.col(c)).alias(c) for c in ch.pcols]).agg(
        F.count(F.lit(1)).alias("_n"), alike.alias("_alike")).where(F.col("_alike").isNotNull()).drop("_alike")
    carry = totals.select(*ch.names(), F.sum("_n").over(ch.earlier()).alias("_cn")).where(F.col("_cn").isNotNull())
    j = ch.with_carry(rows, carry, "left")
    return j.select(*ch.kept, (F.col("_w") + F.coalesce(F.col("_cn"), F.lit(0))).alias("cnt"))


def _keyed(df, key, order, width, aggs, keep=()):
    return prefix_scan(df, [key], [order], chunk_for(df, order, width), aggs, keep=[order, key, *keep])


def rolling_sum(df: DataFrame, key: str = "id", order: str = "arrival", value: str = "vc",
                time: str = "ts_ms", width: int | None = None) -> DataFrame:
    """``sum(value)``: running sum; the other fields keep the key's first row."""
    out = _keyed(df, key, order, width, [Agg("_s", "sum", F.col(value).cast("bigint")),
                                         Agg("_f", "first", F.col(time))])
    return out.select(order, key, F.col("_f").alias(time), F.col("_s").alias(value))


def rolling_max(df: DataFrame, key: str = "id", order: str = "arrival", value: str = "vc",
                time: str = "ts_ms", width: int | None = None, use_min: bool = False) -> DataFrame:
    """``max(value)`` (or min): running extreme; other fields from the first row."""
    out = _keyed(df, key, order, width, [Agg("_m", "min" if use_min else "max", F.col(value)),
                                         Agg("_f", "first", F.col(time))])
    return out.select(order, key, F.col("_f").alias(time), F.col("_m").alias(value))


def rolling_max_by(df: DataFrame, key: str = "id", order: str = "arrival", value: str = "vc",
                   time: str = "ts_ms", width: int | None = None, use_min: bool = False) -> DataFrame:
    """``maxBy(value)`` (or minBy): the whole record holding the running
    extreme; on ties the earliest record stays.

    The record is one struct ``(value, -arrival, time)`` ordered as a whole,
    so the chunk totals are a sort-based aggregate (struct buffers).  The
    primitive alternative – a running max, then the last row that raised it –
    needs two chained scans, i.e. a second full shuffle, which costs more than
    the map-side sort."""
    if use_min:
        rec = F.struct(F.col(value).alias("v"), F.col(order).alias("o"), F.col(time).alias("t"))
        agg = Agg("_r", "min", rec)
    else:
        rec = F.struct(F.col(value).alias("v"), (-F.col(order)).alias("o"), F.col(time).alias("t"))
        agg = Agg("_r", "max", rec)
    out = _keyed(df, key, order, width, [agg])
    return out.select(order, key, F.col("_r.t").alias(time), F.col("_r.v").alias(value))


def rolling_reduce(df: DataFrame, key: str = "id", order: str = "arrival", value: str = "vc",
                   time: str = "ts_ms", width: int | None = None) -> DataFrame:
    """reduce((a, b) -> (a.id, b.ts, a.vc + b.vc)): current ts, running sum."""
    out = _keyed(df, key, order, width, [Agg("_s", "sum", F.col(value).cast("bigint"))], keep=[time])
    return out.select(order, key, time, F.col("_s").alias(value))
