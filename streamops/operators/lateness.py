"""Event-time watermarks, late data and event-time timers (WM1-WM8, T1).

The watermark is per event (punctuated): after a row with time t arrives the
watermark is ``max(t so far) - delay - 1``.  A row is judged against the
watermark of the rows that arrived *before* it.  For a window ending at E
(exclusive), with allowed lateness L:

* on time       E - 1 >  wm_before
* allowed late  E - 1 <= wm_before < E - 1 + L  (counted; the window fires again)
* closed        E - 1 + L <= wm_before          (side output, not counted)

The running max over the global arrival order is a chunked prefix scan, so
no step runs the whole stream through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamops.operators.windows import assign_sliding, assign_tumbling
from streamops.plans.scan import TIME_CHUNK_MS, Agg, chunk_for, chunk_of, floor_div, prefix_scan

ON_TIME, ALLOWED, CLOSED = "on_time", "allowed", "closed"


def watermark_trace(df: DataFrame, delay_ms: int, time: str = "ts_ms",
                    arrival: tuple[str, ...] = ("arr_ms", "arrival"),
                    chunk_width: int | None = None,
                    initial_max: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adds ``wm_before`` / ``wm_after``: the watermark just before and just
    after each row (NULL = no watermark yet).  ``arrival[0]`` is the chunked
    order column (non-decreasing along the arrival order).  ``initial_max`` is
    the max event time of everything that arrived earlier (the streaming
    carry).  ``keep`` names the columns of ``df`` to keep (default: all)."""
    t = F.col(time)
    s = prefix_scan(df, [], list(arrival), chunk_for(df, arrival[0], chunk_width),
                    [Agg("_mx_b", "max", t, inclusive=False), Agg("_mx_a", "max", t, inclusive=True)], keep=keep)
    init = F.lit(initial_max).cast("bigint")
    return (s.withColumn("wm_before", F.greatest(F.col("_mx_b"), init) - F.lit(delay_ms + 1))
             .withColumn("wm_after", F.greatest(F.col("_mx_a"), init) - F.lit(delay_ms + 1))
             .drop("_mx_b", "_mx_a"))


def late_flag(traced: DataFrame, time: str = "ts_ms") -> DataFrame:
    return traced.withColumn("is_late", F.coalesce(F.col(time) < F.col("wm_before"), F.lit(False)))


def classify_tumbling(traced: DataFrame, size_ms: int, lateness_ms: int, time: str = "ts_ms") -> DataFrame:
    d = assign_tumbling(traced, size_ms, time)
    e1, wm = F.col("w_end") - 1, F.col("wm_before")
    cls = (F.when(wm.isNull() | (e1 > wm), F.lit(ON_TIME))
            .when(wm < e1 + F.lit(lateness_ms), F.lit(ALLOWED))
            .otherwise(F.lit(CLOSED)))
    return d.withColumn("lateness", cls)


def classify_sliding(traced: DataFrame, size_ms: int, slide_ms: int, lateness_ms: int,
                     time: str = "ts_ms") -> DataFrame:
    """Per (row, sliding window) pair, the same three classes as tumbling."""
    d = assign_sliding(traced, size_ms, slide_ms, time)
    e1, wm = F.col("w_end") - 1, F.col("wm_before")
    cls = (F.when(wm.isNull() | (e1 > wm), F.lit(ON_TIME))
            .when(wm < e1 + F.lit(lateness_ms), F.lit(ALLOWED))
            .otherwise(F.lit(CLOSED)))
    return d.withColumn("lateness", cls)


def side_output_sliding(traced: DataFrame, size_ms: int, slide_ms: int, lateness_ms: int,
                        time: str = "ts_ms", row_id: str = "arrival") -> DataFrame:
    """Rows whose *every* window is closed.  The newest window of a row ends
    last, so that is the one to test: no per-row grouping of pairs."""
    t = F.col(time)
    newest_end = t - F.pmod(t, F.lit(slide_ms)) + F.lit(size_ms)
    wm = F.col("wm_before")
    return traced.where(wm.isNotNull() & (newest_end - 1 + F.lit(lateness_ms) <= wm))


def window_firings(classified: DataFrame, key: str = "id", value: str = "vc",
                   arrival: tuple[str, ...] = ("arr_ms", "arrival"),
                   chunk_width: int = TIME_CHUNK_MS) -> DataFrame:
    """Changelog of window results with allowed lateness.

    Firing 0 holds the on-time rows (if any).  Every allowed-late row re-fires
    its window at once: firing k carries the count and sum of the on-time rows
    plus the first k allowed-late rows in arrival order.

    The watermark never falls, so all on-time rows of a window arrive before
    its first allowed-late row: one running count and sum over both classes
    gives every firing, and nothing is joined.  The scan is keyed by window, so
    a key spans the chunks of one window only.
    """
    on = classified.where(F.col("lateness") == ON_TIME)
    base = on.groupBy(key, "w_start", "w_end").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(value).cast("bigint").alias("sum_vc"))
    live = classified.where(F.col("lateness") != CLOSED)
    s = prefix_scan(live, [key, "w_start"], list(arrival), chunk_of(arrival[0], chunk_width),
                    [Agg("_k", "count", F.when(F.col("lateness") == ALLOWED, 1)), Agg("_n", "count", F.lit(1)),
                     Agg("_s", "sum", F.col(value).cast("bigint"))])
    refires = s.where(F.col("lateness") == ALLOWED).select(
        key, "w_start", "w_end", F.col("_k").alias("firing"), F.col("_n").alias("cnt"), F.col("_s").alias("sum_vc"))
    return base.select(key, "w_start", "w_end", F.lit(0).cast("bigint").alias("firing"),
                       "cnt", "sum_vc").unionByName(refires)


def periodic_watermark(df: DataFrame, every: int, delay_ms: int, time: str = "ts_ms",
                       arrival: tuple[str, ...] = ("arr_ms", "arrival"),
                       chunk_width: int | None = None, epoch_chunk: int = 1 << 20) -> DataFrame:
    """A generator that emits the watermark once per ``every`` arrivals: a row
    sees the watermark of the last completed epoch (NULL in the first).

    Arrival numbers come from a global count scan; the per-epoch max is an
    aggregate; the carry over epochs is a second scan on the (much smaller)
    epoch table, joined back on the epoch."""
    s = prefix_scan(df, [], list(arrival), chunk_for(df, arrival[0], chunk_width),
                    [Agg("arrival_no", "count", F.lit(1))])
    s = s.withColumn("epoch", floor_div("`arrival_no` - 1", every))
    ep = s.groupBy("epoch").agg(F.max(time).alias("_emax"))
    ep = prefix_scan(ep, [], ["epoch"], chunk_of("epoch", epoch_chunk),
                     [Agg("_prev_max", "max", F.col("_emax"), inclusive=False)])
    ep = ep.select(F.col("epoch").alias("_ep"), (F.col("_prev_max") - F.lit(delay_ms + 1)).alias("wm_periodic"))
    return s.join(ep, s["epoch"] == ep["_ep"]).drop("_ep")


def event_timer_first_fire(df: DataFrame, timer_ms: int, delay_ms: int, key: str = "id",
                           time: str = "ts_ms", arrival: str = "arrival") -> DataFrame:
    """Each key registers an event-time timer at ``timer_ms`` when its first
    row arrives; it fires when the watermark reaches ``timer_ms``.

    The per-event watermark first reaches T at the first arrival whose own
    time is >= T + delay + 1 (a running max first crosses a level at a row
    that crosses it), so the firing arrival is
    ``greatest(first arrival of key, that arrival)``; NULL when only the
    end-of-input flush would fire it.  The global arrival is a scalar
    subquery, not a join.
    """
    cross = df.where(F.col(time) >= F.lit(timer_ms + delay_ms + 1)).agg(F.min(arrival)).scalar()
    first = df.groupBy(key).agg(F.min(arrival).alias("first_arrival"))
    # the subquery is bound to a column once, then used twice
    x = F.col("_cross")
    return (first.withColumn("_cross", cross)
                 .select(key, F.lit(timer_ms).cast("bigint").alias("timer_ms"),
                         F.when(x.isNotNull(), F.greatest(F.col("first_arrival"), x))
                          .cast("bigint").alias("fired_at")))
