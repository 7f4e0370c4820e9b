"""Sessions with late data on a stream: the changelog of ``operators.sessions``
however the input is cut into batches.

Each batch is traced from the greatest event time of all earlier ones and reduced
to records; the sessions that were still kept after the batch before join them and
are replayed first.  The results and the kept sessions of a batch are one table,
written under its batch id before the sink sees it, so a batch that runs again
reads what it read the first time.  Kept sessions are those that the watermark has
not passed by more than the allowed lateness; nothing else is remembered."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamops.operators import sessions
from streamops.operators.lateness import watermark_trace
from streamops.plans.scan import chunk_for
from streamops.streaming import store
from streamops.streaming.lateness import read_carry, write_carry


def session_batches(gap_ms: int, delay_ms: int, lateness_ms: int, root: str, sink, key: str = "id", time: str = "ts_ms",
                    value: str = "vc", arrival: tuple[str, ...] = ("arr_ms", "arrival")):
    """``foreachBatch`` function: ``sink(changes, batch_id)`` with the changelog
    rows of a batch.  ``root`` holds the carries and the kept sessions; batches
    come in arrival order."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_carry(spark, root, batch_id - 1)
        batch = batch.persist()
        try:
            mx = batch.agg(F.max(time).alias("m")).first()["m"]
            top = max((x for x in (mx, before) if x is not None), default=None)
            traced = watermark_trace(batch, delay_ms, time, arrival, initial_max=before, keep=[key, time, value, *arrival])
            recs = sessions.records(traced, gap_ms, key, time, value, arrival, chunk_for(batch, arrival[0]))
            last_wm = None if top is None else top - delay_ms - 1
            results = spark.read.schema(sessions.result_schema(recs))
            if batch_id > 0:
                recs = recs.unionByName(sessions.kept(results.parquet(table_path(root, batch_id - 1)), recs, gap_ms))
            sessions.replay(recs, gap_ms, lateness_ms, last_wm, flush=False).write.mode("overwrite").parquet(
                table_path(root, batch_id))
            sink(sessions.changes(results.parquet(table_path(root, batch_id)), gap_ms, key, value), batch_id)
            write_carry(spark, root, batch_id, top)
            if batch_id > 1:                           # only this batch and the next can be run again
                store.remove(spark, table_path(root, batch_id - 2))
        finally:
            batch.unpersist()

    return run


def table_path(root: str, batch_id: int) -> str:
    return os.path.join(root, f"sessions-{batch_id:012d}")


def open_sessions(spark, root: str, batch_id: int) -> DataFrame:
    """(key, lo, hi, cnt, total, done): the sessions kept after a batch, from
    their first to their last row's time."""
    return spark.read.parquet(table_path(root, batch_id)).where("change = 0").drop("change", "cause", "shown")
