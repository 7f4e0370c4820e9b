"""Windowed aggregation, top-N and joins on streams with Spark watermarks.

These use Spark's per-batch watermark (state is dropped once the watermark
passes); use ``streamops.streaming.lateness`` first when late rows must be
classified exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ms(d: int) -> str:
    return f"{int(d)} milliseconds"


def windowed_counts(stream: DataFrame, size_ms: int, slide_ms: int | None = None, delay_ms: int = 0,
                    keys=("id",), time_col: str = "event_time", value: str = "vc") -> DataFrame:
    """Tumbling/sliding event-time window per key (W4, W5) in append mode."""
    w = F.window(time_col, _ms(size_ms), _ms(slide_ms)) if slide_ms else F.window(time_col, _ms(size_ms))
    return (stream.withWatermark(time_col, _ms(delay_ms)).groupBy(*keys, w.alias("w"))
                  .agg(F.count(F.lit(1)).alias("cnt"), F.sum(value).cast("bigint").alias("sum_vc"))
                  .select(*keys, F.unix_millis("w.start").alias("w_start"), F.unix_millis("w.end").alias("w_end"),
                          "cnt", "sum_vc"))


def session_counts(stream: DataFrame, gap_ms: int, delay_ms: int = 0, key: str = "id",
                   time_col: str = "event_time", value: str = "vc") -> DataFrame:
    """Event-time sessions (W6) in append mode."""
    return (stream.withWatermark(time_col, _ms(delay_ms))
                  .groupBy(key, F.session_window(time_col, _ms(gap_ms)).alias("s"))
                  .agg(F.count(F.lit(1)).alias("cnt"), F.sum(value).cast("bigint").alias("sum_vc"))
                  .select(key, F.unix_millis("s.start").alias("s_start"), F.unix_millis("s.end").alias("s_end"),
                          "cnt", "sum_vc"))


def topn_chained(stream: DataFrame, n: int, size_ms: int, slide_ms: int, delay_ms: int = 0,
                 time_col: str = "event_time", value: str = "vc", shards: int = 64) -> DataFrame:
    """Chained window aggregations (N2): count per (value, window), then the
    top ``n`` of each (window, shard of the values), then of each window.  A
    list holds one shard's distinct values at most, or ``shards * n`` entries;
    raise ``shards`` with the number of distinct values."""
    w = F.window(time_col, _ms(size_ms), _ms(slide_ms))
    counts = (stream.withWatermark(time_col, _ms(delay_ms)).groupBy(w.alias("w"), value)
                    .agg(F.count(F.lit(1)).alias("cnt")))
    entry = F.struct((-F.col("cnt")).alias("nc"), F.col(value).alias("v"))
    part = counts.groupBy("w", F.pmod(F.hash(F.col(value)), F.lit(shards)).alias("_shard")).agg(
        F.slice(F.sort_array(F.collect_list(entry)), 1, n).alias("top"))
    ranked = part.groupBy("w").agg(F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, n).alias("top"))
    return ranked.select(F.unix_millis("w.start").alias("w_start"), F.unix_millis("w.end").alias("w_end"),
                         F.posexplode("top").alias("p", "e")).select(
        "w_start", "w_end", (F.col("p") + 1).cast("bigint").alias("rank"),
        F.col("e.v").alias(value), (-F.col("e.nc")).alias("cnt"))


def window_process_stream(stream: DataFrame, size_ms: int, delay_ms: int = 0, key: str = "id",
                          time: str = "ts_ms", time_col: str = "event_time") -> DataFrame:
    """Full-window function on a stream (W12): when the watermark passes a
    window's end, every element of the window with its bounds and count.  The
    rows of an open window are list state of its (key, window)."""
    from streamops.streaming.processors import WindowProcess
    p = WindowProcess(size_ms)
    w = (stream.withWatermark(time_col, _ms(delay_ms))
               .withColumn("w_start", F.col(time) - F.pmod(F.col(time), F.lit(size_ms))))
    return w.groupBy(key, "w_start").transformWithStateInPandas(
        statefulProcessor=p, outputStructType=p.OUTPUT, outputMode="Append", timeMode="EventTime")


def interval_join_stream(left: DataFrame, right: DataFrame, lower_ms: int, upper_ms: int,
                         delay_ms: int = 0, key: str = "id", time_col: str = "event_time") -> DataFrame:
    """Stream-stream inner interval join (J2); Spark bounds the join state
    from the watermarks and the time range."""
    l = left.withWatermark(time_col, _ms(delay_ms)).select(
        F.col(key).alias("l_id"), F.col("arrival").alias("l_arrival"), F.col(time_col).alias("l_t"))
    r = right.withWatermark(time_col, _ms(delay_ms)).select(
        F.col(key).alias("r_id"), F.col("arrival").alias("r_arrival"), F.col(time_col).alias("r_t"))
    cond = ((F.col("l_id") == F.col("r_id")) &
            (F.col("r_t") >= F.col("l_t") + F.expr(f"INTERVAL {int(lower_ms)} MILLISECONDS")) &
            (F.col("r_t") <= F.col("l_t") + F.expr(f"INTERVAL {int(upper_ms)} MILLISECONDS")))
    return l.join(r, cond).select(F.col("l_id").alias(key), "l_arrival", "r_arrival")


def connect_join_stream(left: DataFrame, right: DataFrame, ttl_ms: int, delay_ms: int = 0, key: str = "id",
                        time_col: str = "event_time") -> DataFrame:
    """Connected keyed streams whose cached rows expire (J3): pairs with equal
    key whose times are less than ``ttl_ms`` apart; the range bounds the state."""
    return interval_join_stream(left, right, -(ttl_ms - 1), ttl_ms - 1, delay_ms, key, time_col)


def processing_time_counts(stream: DataFrame, kind: str, size_ms: int, slide_ms: int | None = None,
                           key: str = "id") -> DataFrame:
    """Processing-time windows (W1 tumbling, W2 sliding, W3 session) over the
    wall clock of each micro-batch; results depend on timing (rows-only)."""
    s = stream.withColumn("proc_time", F.current_timestamp())
    if kind == "tumbling":
        w = F.window("proc_time", _ms(size_ms))
    elif kind == "sliding":
        w = F.window("proc_time", _ms(size_ms), _ms(slide_ms))
    elif kind == "session":
        w = F.session_window("proc_time", _ms(size_ms))
    else:
        raise ValueError(kind)
    return s.groupBy(key, w.alias("w")).agg(F.count(F.lit(1)).alias("cnt"))


def window_join_stream(left: DataFrame, right: DataFrame, size_ms: int, delay_ms: int = 0,
                       key: str = "id", time_col: str = "event_time") -> DataFrame:
    """Stream-stream window join (J1): equal key and equal tumbling window."""
    def side(df, p):
        w = F.window(time_col, _ms(size_ms))
        return (df.withWatermark(time_col, _ms(delay_ms))
                  .select(F.col(key).alias(f"{p}_id"), F.col("arrival").alias(f"{p}_arrival"),
                          F.col(time_col).alias(f"{p}_t"), w.alias(f"{p}_w")))
    l, r = side(left, "l"), side(right, "r")
    return l.join(r, (F.col("l_id") == F.col("r_id")) & (F.col("l_w") == F.col("r_w"))).select(
        F.col("l_id").alias(key), F.unix_millis("l_w.start").alias("w_start"), "l_arrival", "r_arrival")


def word_counts_stream(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Streaming word count (A2): tokenise each line and keep a running count
    per word; in update mode each micro-batch emits the words it changed, and
    the last value per word equals the bounded count (A1)."""
    from streamops.functions.tokenize import words
    return (lines.select(F.explode(words(value_col)).alias("word"))
                 .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))
