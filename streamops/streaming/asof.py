"""Broadcast-state threshold join on a stream (J4, streaming form).

Each micro-batch of data rows is joined as-of by arrival with the config
table: the batch rows, the config rows that arrived since the last batch and
one row carrying the last value before them are run through the batch operator,
so the answer does not depend on how the data stream is cut.  The carry, the
last config value up to a batch's last arrival, is kept per batch id in the
query's folder, so a batch reads only config rows after it (the filter is pushed
into the scan) and a replayed batch reads what it read the first time.  The
config table is read per batch (batch-granular updates, as with a changing
broadcast side)."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamops.operators.joins import asof_threshold
from streamops.streaming import store


def threshold_batches(config: DataFrame, sink, carry_root: str, order: str = "arrival", value: str = "vc",
                      threshold_col: str = "threshold", default: int = 0):
    """``foreachBatch`` function: ``sink(alerts, batch_id)`` per batch."""

    def path(batch_id: int) -> str:
        return os.path.join(carry_root, f"batch={batch_id:012d}")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry = {"upto": None, "order": None, "threshold": None}
        if batch_id > 0:
            text = store.read_text(spark, path(batch_id - 1))
            if text is None:
                raise FileNotFoundError(f"no carry of batch {batch_id - 1} in {carry_root}")
            carry = json.loads(text)
        batch = batch.persist()
        try:
            last = batch.agg(F.max(order)).first()[0]
            if last is not None:
                new = config.where(F.col(order) <= F.lit(last)).select(order, threshold_col)
                if carry["upto"] is not None:
                    new = new.where(F.col(order) > F.lit(carry["upto"]))
                cfg = new
                if carry["order"] is not None:
                    old = spark.range(1).select(F.lit(carry["order"]).cast(new.schema[order].dataType).alias(order),
                                                F.lit(carry["threshold"]).cast(new.schema[threshold_col].dataType).alias(threshold_col))
                    cfg = new.unionByName(old)
                sink(asof_threshold(batch, cfg, order, value, threshold_col, default), batch_id)
                latest = new.where(F.col(threshold_col).isNotNull()).agg(
                    F.max(order).alias("o"), F.max_by(threshold_col, order).alias("t")).first()
                upto = last if carry["upto"] is None else max(last, carry["upto"])
                if latest["o"] is not None:
                    carry = {"order": latest["o"], "threshold": latest["t"]}
                carry["upto"] = upto
            store.write_text(spark, path(batch_id), json.dumps(carry))
        finally:
            batch.unpersist()

    return run


def lookup_batches(config: DataFrame, sink, carry_root: str, by: str, order: str = "arrival", name: str = "name",
                   value: str = "value"):
    """``foreachBatch`` function for broadcast state as a map: ``sink(rows,
    batch_id)`` with each batch row beside what its entry ``by`` held
    (``joins.asof_lookup``).

    The carry is a table, the last put of each entry up to a batch's last
    arrival, written for every batch id; a batch reads it and the config rows
    that came since, so the state may have any number of entries."""
    from streamops.operators.joins import asof_lookup

    def table(batch_id: int) -> str:
        return os.path.join(carry_root, f"entries-{batch_id:012d}")

    def mark(batch_id: int) -> str:
        return os.path.join(carry_root, f"upto={batch_id:012d}")

    cols = [order, name, value]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, upto, old = batch.sparkSession, None, None
        if batch_id > 0:
            text = store.read_text(spark, mark(batch_id - 1))
            if text is None:
                raise FileNotFoundError(f"no carry of batch {batch_id - 1} in {carry_root}")
            upto = json.loads(text)["upto"]
            old = spark.read.schema(config.select(*cols).schema).parquet(table(batch_id - 1))
        batch = batch.persist()
        try:
            last = batch.agg(F.max(order)).first()[0]
            last = upto if last is None else last if upto is None else max(last, upto)
            new = config.where(F.col(order) <= F.lit(last)).select(*cols)
            if upto is not None:
                new = new.where(F.col(order) > F.lit(upto))
            puts = new if old is None else new.unionByName(old)
            sink(asof_lookup(batch, puts, by, order, name, value), batch_id)
            latest = puts.groupBy(name).agg(F.max_by(F.struct(order, value), F.col(order)).alias("_last"))
            latest.select(F.col(f"_last.{order}").alias(order), name, F.col(f"_last.{value}").alias(value)) \
                  .write.mode("overwrite").parquet(table(batch_id))
            store.write_text(spark, mark(batch_id), json.dumps({"upto": last}))
            if batch_id > 1:                           # only this batch and the next can be run again
                store.remove(spark, table(batch_id - 2))
        finally:
            batch.unpersist()

    return run
