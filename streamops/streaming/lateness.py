"""Exact late-data routing on a stream.

Spark's own watermark is per micro-batch and its late filter uses the
previous batch's watermark, so native dropping is looser than the per-event
rule.  Here each micro-batch is classified by the batch operator, seeded
with the max event time of all earlier batches.  That carry is stored per
batch id under the query's checkpoint folder, so a replayed batch reads
exactly the value it read the first time.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamops.operators import lateness
from streamops.streaming import store


def _carry_path(root: str, batch_id: int) -> str:
    return os.path.join(root, f"batch={batch_id:012d}")


def read_carry(spark, root: str, batch_id: int):
    """Max event time after batch ``batch_id`` (None before the first, and if
    no row has come yet).  Every batch writes its carry, so a missing or broken
    one is an error, not an empty start."""
    if batch_id < 0:
        return None
    text = store.read_text(spark, _carry_path(root, batch_id))
    if text is None:
        raise FileNotFoundError(f"no carry of batch {batch_id} in {root}")
    return json.loads(text)["max_ts"]


def write_carry(spark, root: str, batch_id: int, max_ts) -> None:
    store.write_text(spark, _carry_path(root, batch_id), json.dumps({"max_ts": max_ts}))


def classify_batches(carry_root: str, delay_ms: int, size_ms: int, lateness_ms: int, sink,
                     time: str = "ts_ms", arrival=("arr_ms", "arrival"), slide_ms: int | None = None):
    """A ``foreachBatch`` function: classify every row of the batch as on
    time / allowed / closed with the exact per-event rule and hand the
    classified frame to ``sink(df, batch_id)``.  With ``slide_ms`` the windows
    slide and there is one classified row for each (row, window).

    Batches must arrive in arrival order (the usual source contract)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        init = read_carry(spark, carry_root, batch_id - 1)
        batch = batch.persist()
        try:
            traced = lateness.watermark_trace(batch, delay_ms, time, arrival, initial_max=init)
            if slide_ms:
                classified = lateness.classify_sliding(traced, size_ms, slide_ms, lateness_ms, time)
            else:
                classified = lateness.classify_tumbling(traced, size_ms, lateness_ms, time)
            sink(classified, batch_id)
            mx = batch.agg(F.max(time).alias("m")).first()["m"]
            write_carry(spark, carry_root, batch_id, max((x for x in (mx, init) if x is not None), default=None))
        finally:
            batch.unpersist()

    return run


def routed_rows_sink(path: str):
    """Sink for ``classify_batches``: every classified row (closed rows
    included, tagged) goes to ``path/batch_id=N``, written once per batch id
    (replay-safe); the input of ``window_updates``."""
    from streamops.streaming.sinks import idempotent_parquet_sink

    return idempotent_parquet_sink(path)


def window_updates(spark, routed_path: str, schema, size_ms: int, delay_ms: int, lateness_ms: int,
                   key: str = "id", value: str = "vc", time: str = "ts_ms") -> DataFrame:
    """Second stage: a stream over the routed rows; on-time and allowed-late
    rows update their window's count and sum (update output mode, one update
    per window per micro-batch).  Closed rows go nowhere: they are the side
    output.  The last update of a window equals its final batch firing.

    State is bounded by a Spark watermark of ``size + delay + lateness``: an
    allowed row of window [S, E) arrives while the max event time is below
    E + delay + lateness, and its own time is at least E - size, so Spark's
    (one batch behind) late filter never drops it, while windows older than
    that are evicted from the state store."""
    routed = spark.readStream.schema(schema).parquet(routed_path)
    keep = (routed.where(F.col("lateness") != lateness.CLOSED)
                  .withColumn("_et", F.timestamp_millis(F.col(time)))
                  .withWatermark("_et", f"{int(size_ms + delay_ms + lateness_ms)} milliseconds"))
    return (keep.groupBy(key, F.window("_et", f"{int(size_ms)} milliseconds").alias("_w"))
                .agg(F.count(F.lit(1)).alias("cnt"), F.sum(value).cast("bigint").alias("sum_vc"))
                .select(key, F.unix_millis("_w.start").alias("w_start"), F.unix_millis("_w.end").alias("w_end"),
                        "cnt", "sum_vc"))


def firings_stream(spark, routed_path: str, schema, size_ms: int, delay_ms: int, lateness_ms: int,
                   key: str = "id", time: str = "ts_ms") -> DataFrame:
    """Second stage with one output row per firing, as in the batch form:
    firing 0 when the first allowed-late row comes (or the window's time is
    over), then one firing for every allowed-late row.  ``key`` must be a
    string column and the value column is ``vc``."""
    from streamops.streaming.processors import WindowFirings
    routed = spark.readStream.schema(schema).parquet(routed_path)
    live = (routed.where(F.col("lateness") != lateness.CLOSED)
                  .withColumn("_et", F.timestamp_millis(F.col(time)))
                  .withWatermark("_et", f"{int(size_ms + delay_ms + lateness_ms)} milliseconds"))
    p = WindowFirings(size_ms)
    return live.groupBy(key, "w_start").transformWithStateInPandas(
        statefulProcessor=p, outputStructType=p.OUTPUT, outputMode="Append", timeMode="EventTime")
