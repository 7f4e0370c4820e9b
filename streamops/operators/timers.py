"""Event-time timers with every firing (T1).

A row registers a timer for its key at a time of its own (``at``).  A timer
fires when the watermark reaches its time; the watermark moves after a row whose
event time is the largest so far (``max(t so far) - delay - 1``, per event).  A
time that has passed when the row arrives fires at the next move, so a key that
registers one fixed time with every row is armed again after each firing.
Registering a time twice before it fires is one timer.

Replay.  The moves of the watermark are a strictly rising sequence, so a timer's
firing is a lookup by value: with ``due = greatest(at, watermark before the row
+ 1)`` it fires at the first move whose watermark is at least ``due`` (no move
before the row can be: they are below ``due``).

1. the watermark before and after each row: a chunked scan in arrival order;
2. registrations combined map-side to (key, at, due), moves are the rows that
   raise the watermark;
3. the distinct due values and the moves in one chunked scan by value, downward:
   the next due time's move is the carry between chunks;
4. the values go back to the registrations by an equi-join, and equal firings of
   a timer are one.

No key is replayed in one task, and nothing is ordered by key at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamops.operators.lateness import watermark_trace
from streamops.plans.scan import Agg, chunk_for, prefix_scan


def moves(traced: DataFrame, arrival: str = "arrival") -> DataFrame:
    """(wm, fired_at): the rows after which the watermark is higher than before."""
    up = F.col("wm_before").isNull() | (F.col("wm_after") > F.col("wm_before"))
    return traced.where(up & F.col("wm_after").isNotNull()).select(F.col("wm_after").alias("wm"), F.col(arrival).alias("fired_at"))


def registrations(traced: DataFrame, at: Column, key: str = "id") -> DataFrame:
    """(key, timer_ms, due, n): the timers that rows register, combined.  A NULL
    time registers none; NULL is a key like any other."""
    due = F.greatest(F.col("timer_ms"), F.col("wm_before") + 1)
    return (traced.withColumn("timer_ms", at.cast("bigint")).where(F.col("timer_ms").isNotNull())
                  .groupBy(key, "timer_ms", due.alias("due")).agg(F.count(F.lit(1)).alias("n")))


def first_moves(due: DataFrame, moved: DataFrame, chunk: Column | None = None, value: str = "due") -> DataFrame:
    """(due, fired_at, wm) for each distinct ``due``: the first move whose
    watermark is at least ``due``, NULL where there is none.  ``chunk``, if
    given, is a chunk number of the column ``value``, rising with it."""
    wanted = due.select("due").distinct().select(
        F.col("due").alias(value), F.lit(1).alias("_kind"), F.lit(None).cast("bigint").alias("wm"),
        F.lit(None).cast(moved.schema["fired_at"].dataType).alias("fired_at"))
    given = moved.select(F.col("wm").alias(value), F.lit(0).alias("_kind"), "wm", "fired_at")
    u = given.unionByName(wanted).withColumn("_down", -F.col(value))
    move = F.when(F.col("_kind") == 0, F.struct("wm", "fired_at"))
    s = prefix_scan(u, [], ["_down", "_kind"], -chunk if chunk is not None else chunk_for(u, "_down"),
                    [Agg("_move", "last_nonnull", move)], keep=["_down", "_kind"])
    return s.where(F.col("_kind") == 1).select((-F.col("_down")).alias("due"), F.col("_move.fired_at").alias("fired_at"),
                                               F.col("_move.wm").alias("wm"))


def firings(registered: DataFrame, moved: DataFrame, key: str = "id", chunk: Column | None = None,
            value: str = "due") -> DataFrame:
    """(key, timer_ms, fired_at, wm, registered): one row for each firing of a
    timer; ``fired_at`` is the row after which it fires, ``wm`` the watermark
    then, ``registered`` the rows that had asked for it since it last fired.
    Both are NULL where only the end of the input would fire it."""
    at = first_moves(registered, moved, chunk, value)
    return (registered.join(at, "due").groupBy(key, "timer_ms", "fired_at", "wm")
                      .agg(F.sum("n").cast("bigint").alias("registered")))


def event_timers(df: DataFrame, at: Column, delay_ms: int, key: str = "id", time: str = "ts_ms",
                 arrival: tuple[str, ...] = ("arr_ms", "arrival"), chunk_width: int | None = None) -> DataFrame:
    """Every firing of the timers that the rows of ``df`` register at ``at``
    (an expression of their columns; a constant for one fixed time)."""
    traced = watermark_trace(df, delay_ms, time, arrival, chunk_width)
    return firings(registrations(traced, at, key), moves(traced, arrival[-1]), key, chunk_for(df, time, chunk_width), time)
