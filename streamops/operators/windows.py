"""Window assigners and window functions (W4-W15) on epoch-ms BIGINT time.

Windows are half-open ``[w_start, w_end)`` aligned to epoch 0; only windows
that hold rows produce output.  Assignment is integer arithmetic in the
projection (codegen, no shuffle); every window function is a hash aggregate
with partial aggregation, so a hot key or hot window is combined map-side.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamops.plans.scan import Agg, chunk_for, chunk_of, floor_div, halo_scan, prefix_scan


def assign_tumbling(df: DataFrame, size_ms: int, time: str = "ts_ms") -> DataFrame:
    t = F.col(time)
    start = t - F.pmod(t, F.lit(size_ms))
    return df.withColumn("w_start", start).withColumn("w_end", start + F.lit(size_ms))


def assign_sliding(df: DataFrame, size_ms: int, slide_ms: int, time: str = "ts_ms") -> DataFrame:
    """One row per (row, window).  Starts are multiples of ``slide_ms``; a row
    falls in ceil(size/slide) windows or one fewer when size % slide != 0."""
    t = F.col(time)
    last = t - F.pmod(t, F.lit(slide_ms))
    m = -(-size_ms // slide_ms)
    starts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(m - 1)),
                                  lambda j: last - j.cast("bigint") * F.lit(slide_ms)),
                      lambda s: s > t - F.lit(size_ms))
    return (df.withColumn("w_start", F.explode(starts))
              .withColumn("w_end", F.col("w_start") + F.lit(size_ms)))


def count_sum(value: str = "vc"):
    return [F.count(F.lit(1)).alias("cnt"), F.sum(F.col(value)).cast("bigint").alias("sum_vc")]


def window_count_sum(windowed: DataFrame, keys: list[str], value: str = "vc") -> DataFrame:
    return windowed.groupBy(*keys, "w_start", "w_end").agg(*count_sum(value))


def tumbling_agg(df, size_ms, keys=("id",), time="ts_ms", value="vc"):
    return window_count_sum(assign_tumbling(df, size_ms, time), list(keys), value)


def panes(df: DataFrame, size_ms: int, slide_ms: int, keys: list[str], aggs: list, time: str = "ts_ms") -> DataFrame:
    """``aggs`` per (keys, pane), panes being gcd(size, slide) wide: every
    sliding window is a union of whole panes, so rows are combined map-side
    once, and only panes are copied to the windows that hold them."""
    pane = math.gcd(size_ms, slide_ms)
    t = F.col(time)
    return df.groupBy(*keys, (t - F.pmod(t, F.lit(pane))).alias("_pane")).agg(*aggs)


def sliding_agg(df, size_ms, slide_ms, keys=("id",), time="ts_ms", value="vc"):
    p = panes(df, size_ms, slide_ms, list(keys), [F.count(F.lit(1)).alias("_c"), F.sum(F.col(value)).cast("bigint").alias("_s")],
              time)
    return assign_sliding(p, size_ms, slide_ms, "_pane").groupBy(*keys, "w_start", "w_end").agg(
        F.sum("_c").cast("bigint").alias("cnt"), F.sum("_s").cast("bigint").alias("sum_vc"))


def window_reduce(df, size_ms, key="id", time="ts_ms", value="vc", order="arrival"):
    """reduce in a window: the time of the last arrival, the values summed."""
    w = assign_tumbling(df, size_ms, time)
    return w.groupBy(key, "w_start", "w_end").agg(
        F.max_by(F.col(time), F.col(order)).alias(time),
        F.sum(F.col(value)).cast("bigint").alias(value))


def window_aggregate_string(df, size_ms, key="id", time="ts_ms", value="vc"):
    """Typed accumulator (sum) with a string result; merge is a true merge."""
    w = assign_tumbling(df, size_ms, time)
    return w.groupBy(key, "w_start", "w_end").agg(
        F.sum(F.col(value)).cast("bigint").cast("string").alias("agg_out"))


def window_process(df, size_ms, key="id", time="ts_ms", cols=("arrival", "ts_ms", "vc")):
    """Full-window function: every element with its window's key, bounds and
    count.  Elements stay rows (no per-window list), so a large window never
    has to fit in one task's memory; the count is aggregated and joined back
    on (key, window)."""
    w = assign_tumbling(df, size_ms, time)
    cnt = w.groupBy(F.col(key).alias("_k"), F.col("w_start").alias("_w")).agg(F.count(F.lit(1)).alias("cnt"))
    same = w[key].eqNullSafe(cnt["_k"]) & (w["w_start"] == cnt["_w"])   # NULL is a key like any other
    return w.join(cnt, same).select(key, "w_start", "w_end", "cnt", *cols)


def global_window(df, key="id", value="vc"):
    return df.groupBy(key).agg(*count_sum(value))


def session_agg(df: DataFrame, gap_ms: int, key: str = "id", time: str = "ts_ms",
                order: str = "arrival", value: str = "vc") -> DataFrame:
    """Event-time sessions: a row spans ``[t, t + gap)`` and touching spans
    merge, i.e. a new session starts when the gap to the key's previous row
    (in time order) is larger than ``gap_ms``.

    Two rows in the same ``gap_ms``-wide time bucket are less than a gap
    apart, so a session boundary never falls inside a bucket.  Rows are
    therefore first pre-aggregated per (key, bucket) – a hash aggregate with
    map-side combine – and the gap-and-island scan runs over that bucket
    table (at most range / gap rows per key), never over raw rows.  A hot key
    is reduced before any per-key ordering happens.  ``order`` is unused: rows
    with equal times fall in one bucket.
    """
    if gap_ms <= 0:
        raise ValueError("gap_ms must be positive")
    b = (df.withColumn("_b", chunk_of(time, gap_ms)).groupBy(key, "_b")
           .agg(F.min(time).alias("_mn"), F.max(time).alias("_mx"),
                F.count(F.lit(1)).alias("_cnt"), F.sum(value).cast("bigint").alias("_sum")))
    # The bucket table has at most (time range / gap) rows per key whatever
    # the data volume, so one ordered window per key over it is bounded; lag
    # and the running session number share its single sort.
    w = Window.partitionBy(key).orderBy("_b")
    pmx = F.lag("_mx").over(w)
    s = b.withColumn("_new", F.when(pmx.isNull() | (F.col("_mn") - pmx > gap_ms), 1).otherwise(0))
    s = s.withColumn("_sess", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(key, "_sess").agg(
        F.min("_mn").alias("s_start"), (F.max("_mx") + F.lit(gap_ms)).alias("s_end"),
        F.sum("_cnt").alias("cnt"), F.sum("_sum").cast("bigint").alias("sum_vc")).drop("_sess")


def count_window_tumbling(df: DataFrame, size: int, key: str = "id", order: str = "arrival",
                          value: str = "vc", width: int | None = None) -> DataFrame:
    """countWindow(size): consecutive groups of ``size`` rows per key; an
    incomplete tail never fires."""
    s = prefix_scan(df, [key], [order], chunk_for(df, order, width), [Agg("_rn", "count", F.lit(1))],
                    keep=[key, order, value])
    s = s.withColumn("win_no", floor_div("`_rn` - 1", size))
    g = s.groupBy(key, "win_no").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(value).cast("bigint").alias("sum_vc"),
        F.min(order).alias("first_arrival"), F.max(order).alias("last_arrival"))
    return g.where(F.col("cnt") == size)


def count_window_sliding(df: DataFrame, size: int, slide: int, key: str = "id",
                         order: str = "arrival", value: str = "vc", width: int | None = None) -> DataFrame:
    """countWindow(size, slide): fires after every ``slide``-th row of a key,
    over its last (up to) ``size`` rows.

    The frame itself is evaluated (``halo_scan``): each chunk gets the values of
    the ``size - 1`` rows before it, so a window without any value sums to NULL,
    and a hot key is spread over its chunks without a self-join on positions."""
    s = halo_scan(df, [key], [order], chunk_for(df, order, width), F.col(value).cast("bigint"), size,
                  {"_s": F.sum("_v")}, keep=[key, order])
    s = s.where(F.pmod(F.col("_pos"), F.lit(slide)) == 0)
    known = F.filter("_halo", lambda v: v.isNotNull())
    before = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0).cast("bigint"), lambda a, v: a + v))
    return s.select(key, F.col("_pos").alias("pos"), F.col(order).alias("fire_arrival"),
                    F.least(F.col("_pos"), F.lit(size)).alias("cnt"),
                    F.coalesce(F.col("_s") + before, "_s", before).alias("sum_vc"))


# legacy full-window apply (W13) has the same output as the process function
window_apply = window_process
