"""Global window with a trigger and purge rule of the user's (W9).

A key's rows all belong to one window.  After each row, in arrival order, the
trigger says whether the window fires; with ``purge`` its contents are given out
and cleared, without they stay and the next firing holds them too.

A trigger has up to three rules; the window fires when any of them does:

    when     a condition on the row
    every_ms the row's time lies in a later interval than the key's latest time
             before it (intervals of this length, from the epoch)
    count    this many rows have come since the last firing (of any rule)

Positions of firings are a segmented scan with resets: rows that fire by ``when``
or ``every_ms`` cut a key's rows into segments, and ``count`` fires at every
count-th place of a segment.  The contents of a firing are the rows since the
last one (``purge``: a partial aggregate by firing number) or all rows so far (a
running aggregate).  Only chunked scans are used, so a hot key is spread.

A condition that is NULL does not fire; a NULL time is no time; NULL is a key
like any other; rows after the last firing are given out by none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamops.plans.scan import Agg, chunk_for, floor_div, prefix_scan


@dataclass(frozen=True)
class Trigger:
    """When a global window fires.  ``when`` is an SQL condition on the row."""

    when: str | None = None
    every_ms: int | None = None
    count: int | None = None

    def __post_init__(self):
        if not (self.when or self.every_ms or self.count):
            raise ValueError("a trigger needs a rule")
        if (self.every_ms or 1) < 1 or (self.count or 1) < 1:
            raise ValueError("every_ms and count must be positive")


def _cuts(df: DataFrame, trigger: Trigger, key: str, order: str, time: str, chunk: Column, keep: list[str]) -> DataFrame:
    """Adds ``_cut``, the row fires by its own condition or time, and ``_pos``,
    its place in the key, where the trigger counts."""
    own = F.coalesce(F.expr(trigger.when), F.lit(False)) if trigger.when else F.lit(False)
    df = df.withColumn("_own", own)
    aggs = [Agg("_late", "max", F.col(time), inclusive=False)] if trigger.every_ms else []
    aggs += [Agg("_pos", "count", F.lit(1))] if trigger.count else []
    if aggs:
        df = prefix_scan(df, [key], [order], chunk, aggs, keep=[*keep, "_own"])
    cut = F.col("_own")
    if trigger.every_ms:
        later = floor_div(f"`{time}`", trigger.every_ms) > floor_div("`_late`", trigger.every_ms)
        cut = cut | F.coalesce(later, F.lit(False))
    return df.select(*keep, cut.alias("_cut"), *(["_pos"] if trigger.count else []))


def firing_rows(df: DataFrame, trigger: Trigger, key: str = "id", order: str = "arrival", time: str = "ts_ms",
                value: str = "vc", width: int | None = None) -> DataFrame:
    """key, order, time, value, ``fires`` and ``firing``: whether the window
    fires after the row, and the number (from 0) of the next firing."""
    chunk, keep = chunk_for(df, order, width), list(dict.fromkeys([key, order, time, value]))
    d = _cuts(df, trigger, key, order, time, chunk, keep)
    if trigger.count:
        # the row's place after the last cut before it
        if trigger.when or trigger.every_ms:
            d = prefix_scan(d, [key], [order], chunk, [Agg("_last", "last_nonnull", F.when(F.col("_cut"), F.col("_pos")), inclusive=False)],
                            keep=[*keep, "_cut", "_pos"])
            place = F.col("_pos") - F.coalesce("_last", F.lit(0))
        else:
            place = F.col("_pos")
        d = d.select(*keep, (F.col("_cut") | (F.pmod(place, F.lit(trigger.count)) == 0)).alias("fires"))
    else:
        d = d.select(*keep, F.col("_cut").alias("fires"))
    return prefix_scan(d, [key], [order], chunk, [Agg("firing", "count", F.when(F.col("fires"), 1), inclusive=False)],
                       keep=[*keep, "fires"])


def global_window_trigger(df: DataFrame, trigger: Trigger, purge: bool = True, key: str = "id", order: str = "arrival",
                          time: str = "ts_ms", value: str = "vc", width: int | None = None) -> DataFrame:
    """One row for each firing: key, firing (0, 1, ...), fire_arrival, and of
    the contents cnt, sum_vc, first_arrival."""
    d = firing_rows(df, trigger, key, order, time, value, width)
    per = d.groupBy(key, "firing").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(F.col(value)).cast("bigint").alias("sum_vc"),
        F.min(order).alias("first_arrival"), F.max(F.when(F.col("fires"), F.col(order))).alias("fire_arrival"))
    fired = per.where(F.col("fire_arrival").isNotNull())
    cols = [key, "firing", "fire_arrival", "cnt", "sum_vc", "first_arrival"]
    if purge:
        return fired.select(*cols)
    # contents that stay: running totals over the firings, in the chunks of their rows
    s = prefix_scan(fired.withColumnRenamed("fire_arrival", order), [key], [order], chunk_for(df, order, width), [
        Agg("cnt", "sum", F.col("cnt")), Agg("sum_vc", "sum", F.col("sum_vc")), Agg("first_arrival", "first", F.col("first_arrival"))],
        keep=[key, "firing", order])
    return s.withColumnRenamed(order, "fire_arrival").select(*cols)
