"""Event-time timers with every firing on a stream (T1).

The watermark is the exact per-event one, not Spark's (which moves once a
micro-batch): each batch is traced from the greatest event time of all earlier
batches.  Timers that have not fired are a table, sorted out by the same lookup
as in the batch form: what is due by a move of this batch fires, the rest is
written as the pending timers of this batch id.  So firings do not depend on how
the input is cut, and a replayed batch reads what it read the first time.  A key
may hold any number of timers; nothing is kept in the memory of a task."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamops.operators import timers
from streamops.operators.lateness import watermark_trace
from streamops.streaming import store


def timer_batches(at: Column, delay_ms: int, root: str, sink, key: str = "id", time: str = "ts_ms",
                  arrival: tuple[str, ...] = ("arr_ms", "arrival")):
    """``foreachBatch`` function: ``sink(firings, batch_id)`` with the firings
    of a batch (key, timer_ms, fired_at, wm, registered).  ``root`` holds the
    carries and the pending timers; batches come in arrival order."""

    def carry_path(batch_id: int) -> str:
        return os.path.join(root, f"carry={batch_id:012d}")

    def pending_path(batch_id: int) -> str:
        return os.path.join(root, f"pending-{batch_id:012d}")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, None
        if batch_id > 0:
            text = store.read_text(spark, carry_path(batch_id - 1))
            if text is None:
                raise FileNotFoundError(f"no carry of batch {batch_id - 1} in {root}")
            before = json.loads(text)["max_ts"]
        batch = batch.persist()
        try:
            traced = watermark_trace(batch, delay_ms, time, arrival, initial_max=before)
            registered = timers.registrations(traced, at, key)
            if batch_id > 0:
                old = spark.read.schema(registered.schema).parquet(pending_path(batch_id - 1))
                registered = registered.unionByName(old).groupBy(key, "timer_ms", "due").agg(F.sum("n").alias("n"))
            found = registered.join(timers.first_moves(registered, timers.moves(traced, arrival[-1])), "due").persist()
            fired = found.where(F.col("fired_at").isNotNull()).groupBy(key, "timer_ms", "fired_at", "wm").agg(
                F.sum("n").cast("bigint").alias("registered"))
            sink(fired, batch_id)
            found.where(F.col("fired_at").isNull()).select(key, "timer_ms", "due", "n").write.mode("overwrite").parquet(
                pending_path(batch_id))
            found.unpersist()
            mx = batch.agg(F.max(time).alias("m")).first()["m"]
            store.write_text(spark, carry_path(batch_id), json.dumps(
                {"max_ts": max((x for x in (mx, before) if x is not None), default=None)}))
            if batch_id > 1:                           # only this batch and the next can be run again
                store.remove(spark, pending_path(batch_id - 2))
        finally:
            batch.unpersist()

    return run


def pending(spark, root: str, batch_id: int) -> DataFrame:
    """The timers that had not fired after batch ``batch_id``."""
    return spark.read.parquet(os.path.join(root, f"pending-{batch_id:012d}"))
